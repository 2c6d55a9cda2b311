"""Postal addresses as people type them, taken apart."""

from __future__ import annotations

import re
from functools import lru_cache
from typing import NamedTuple

from dossier.llm.aliases import STATES, TOWN_WORDS
from dossier.llm.names import LOOKALIKE, plain, within

#: Street type -> other spellings. Fixed values.
STREET_TYPES = {
    "street": "st str strt", "avenue": "av ave aven avn", "boulevard": "blvd boul bvd bl", "road": "rd", "drive": "dr drv", "lane": "ln", "court": "ct crt", "place": "pl plc", "terrace": "ter terr trc",
    "parkway": "pkwy pky parkwy pkway pwy", "circle": "cir circ", "highway": "hwy hiway", "square": "sq", "trail": "trl", "way": "wy", "plaza": "plz", "alley": "aly", "crescent": "cres", "turnpike": "tpke", "expressway": "expy",
}
DIRECTIONS = {"n": "n", "no": "n", "north": "n", "s": "s", "so": "s", "south": "s", "e": "e", "east": "e", "w": "w", "west": "w", "ne": "ne", "nw": "nw", "se": "se", "sw": "sw", "northeast": "ne", "northwest": "nw", "southeast": "se", "southwest": "sw"}
ORDINALS = {"first": "1st", "second": "2nd", "third": "3rd", "fourth": "4th", "fifth": "5th", "sixth": "6th", "seventh": "7th", "eighth": "8th", "ninth": "9th", "tenth": "10th", "eleventh": "11th", "twelfth": "12th"}

_TYPE = {form: formal for formal, forms in STREET_TYPES.items() for form in [formal, *forms.split()]}
_STATE = {code.lower(): code for code in STATES} | {name.lower(): code for code, name in STATES.items()}
#: Last word of a state -> the states that end in it, the longest first.
_STATE_BY_END = {end: sorted((name for name in _STATE if name.split()[-1] == end), key=len, reverse=True) for end in {name.split()[-1] for name in _STATE}}
_COUNTRY = re.compile(r"[,\s]*\b(?:usa|u\.s\.a\.?|u\.s\.|united states(?: of america)?)\s*$")
_ZIP = re.compile(r"(?:^|[,\s])\s*(\d{5})(?:-?\d{4})?\s*$")
_BOX = re.compile(r"\b(?:p\.?\s*o\.?\s*|post\s+office\s+|postal\s+)?(?:box|b0x)\s*(?:no\.?\s*|#\s*)?(\d+)\b|\bp\.?\s*o\.?\s*b\.?\s+(\d+)\b")
_COUNTRY_ENDS = ("usa", "u.s.a", "u.s.a.", "u.s.", "united states", "america")
_UNIT_WORDS = ("#", "suite", "ste", "unit", "room", "rm", "apt", "apartment", "floor", "bldg", "building", "office", "ofc")
_UNIT = re.compile(r"(?:\b(?:suite|ste|unit|room|rm|apt|apartment|floor|bldg|building|office|ofc)\b\.?\s*(?:#\s*|no\.?\s*)?(?:\d+[a-z]?|[a-z]\d*)\b|#\s*[a-z0-9-]+)")
_AREA = re.compile(r"^greater\s+(.+?)(?:,\s*[a-z]{2})?\s+area\b")
_NUMBER = re.compile(r"^(\d+[a-z]?)\s+(.+)$")
_GREATER, _TOWN_OF = re.compile(r"^(?:greater\s+)(.*?)(?:\s+area)?$"), re.compile(r"^(?:the )?(?:city|town|village) of ")
_STATE_FIRST, _ORDINAL, _STOPS, _OTHERS, _OTHER = re.compile(r"^([a-z]{2})\s*-\s*(.+)$"), re.compile(r"\d+(st|nd|rd|th)?"), re.compile(r"[\s.]+"), re.compile(r"[^a-z0-9]+"), re.compile(r"[^a-z0-9]")


class Place(NamedTuple):
    """number is "" where the text names no street and number; a box has number "box" + its digits and an empty street."""

    number: str
    street: str
    kind: str
    side: str
    town: str
    state: str
    zip: str


NOWHERE = Place("", "", "", "", "", "", "")


@lru_cache(maxsize=50_000)
def town_key(text: str) -> str:
    text = _TOWN_OF.sub("", _GREATER.sub(r"\1", text.strip(" ,.-")))
    words = [w for w in _OTHERS.split(text) if w]
    if words and words[0] == "s":
        words[0] = "saint"
    return "".join(TOWN_WORDS.get(w, w) for w in words)


@lru_cache(maxsize=50_000)
def _word(word: str) -> str:
    """A word of a street without look-alike digits, numbers written in figures."""
    if _ORDINAL.fullmatch(word):
        return word
    word = word.translate(LOOKALIKE)
    if word in ORDINALS or len(word) < 5 or word in _TYPE:
        return ORDINALS.get(word, word)
    return next((figure for name, figure in ORDINALS.items() if within(word, name, 1)), word)


def _street(words: list[str], whole: bool) -> tuple[str, str, str, list[str]]:
    """(street, kind, side, words behind it). ``whole``: the words are all of a part between commas."""
    side = ""
    if len(words) > 1 and words[0] in DIRECTIONS and words[1] not in _TYPE:
        side, words = DIRECTIONS[words[0]], words[1:]
    at = next((i for i in range(1, len(words)) if words[i] in _TYPE), None)
    if at is None and whole and len(words) > 1 and len(words[-1]) > 3:
        near = next((t for t in STREET_TYPES if within(words[-1], t, 1 if len(t) < 6 else 2)), None)
        if near:
            return "".join(words[:-1]), near, side, []
    if at is None:
        kind, core, rest = "", words, []
        if whole and len(core) > 1 and core[-1] in DIRECTIONS:
            side, core = side or DIRECTIONS[core[-1]], core[:-1]
        if not whole:  # nothing parts street and town here; most streets are one word
            core, rest = core[:1], core[1:]
    else:
        kind, core, rest = _TYPE[words[at]], words[:at], words[at + 1 :]
        if rest and rest[0] in DIRECTIONS and (len(rest) == 1 or len(rest[0]) < 3 and rest[1] in DIRECTIONS):
            side, rest = side or DIRECTIONS[rest[0]], rest[1:]
    return "".join(core), kind, side, rest


def _state_end(s: str) -> tuple[str, str] | None:
    """(the text before it, the state) where ``s``, which has neither a blank nor a comma at its end, ends in one; the longest name counts."""
    s = s.removesuffix(".")
    for name in _STATE_BY_END.get(s[max(s.rfind(" "), s.rfind(",")) + 1 :], ()):
        before = s[: -len(name)]
        if s.endswith(name) and (not before or before[-1] in ", "):
            return before.strip(" ,"), _STATE[name]
    return None


@lru_cache(maxsize=50_000)
def parse_place(text: str | None) -> Place:
    """Take a written address apart. Suite, unit and room go; null, blank or a mere town gives a Place without a number."""
    if not text or not text.strip():
        return NOWHERE
    # Most addresses lack most of these parts, so the patterns only run where the letters that they need are there.
    s = plain(text)
    s = (_COUNTRY.sub("", s) if s.endswith(_COUNTRY_ENDS) else s).strip(" ,")
    s = _AREA.sub(r"\1", s) if s.startswith("greater") else s
    zip_, state = "", ""
    if s[-1:].isdecimal() and (m := _ZIP.search(s)):
        zip_, s = m.group(1), s[: m.start()].strip(" ,")
    while found := _state_end(s):
        if state and found[1] != state or not found[0]:
            break
        s, state = found
    if not state and (m := _STATE_FIRST.match(s)) and m.group(1) in _STATE:
        state, s = _STATE[m.group(1)], m.group(2)
    if not state and s in _STATE:
        return Place("", "", "", "", "", _STATE[s], zip_)
    if ("box" in s or "b0x" in s or "b " in s or "b. " in s) and (m := _BOX.search(s)):
        rest = _UNIT.sub(",", s[m.end() :])
        return Place("box" + (m.group(1) or m.group(2)).lstrip("0"), "", "", "", town_key(rest), state, zip_)
    s = _UNIT.sub(" , ", s) if any(w in s for w in _UNIT_WORDS) else s
    parts = [p for p in (" ".join(p.split()).strip(" .-") for p in s.split(",")) if p]
    for i, part in enumerate(parts):
        if m := _NUMBER.match(part):
            words = [_word(w) for w in (w if w.isascii() and w.isalnum() else _OTHER.sub("", w) for w in _STOPS.split(m.group(2))) if w]
            if not words:
                continue
            street, kind, side, rest = _street(words, i + 1 < len(parts) or not state)
            town = " ".join(rest) or " ".join(parts[i + 1 :])
            return Place(m.group(1).lstrip("0") or "0", street, kind, side, town_key(town), state, zip_)
    return Place("", "", "", "", town_key(parts[-1]) if parts else "", state, zip_)


def join_parts(line1: str | None, line2: str | None, city: str | None, state: str | None, zip_: str | None) -> str | None:
    """One text of the address keys of a profile; a line that already has the town is not followed by it again."""
    kept = [x.strip() for x in (line1, line2) if x and x.strip()]
    tail = " ".join(x.strip() for x in (state, zip_) if x and x.strip())
    town = (city or "").strip()
    if town and tail and town.upper().endswith(", " + (state or "?").strip().upper()):
        town = town.rpartition(",")[0]
    return ", ".join([*kept, *([town] if town else []), *([tail] if tail else [])]) or None


def same_town(a: Place, b: Place) -> bool:
    """Whether state, town and zip of two places can be one: nothing contradicts and something agrees."""
    if a.state and b.state and a.state != b.state:
        return False
    if a.zip and a.zip == b.zip:
        return True
    if a.town and b.town:
        return a.town == b.town or a.town + "city" == b.town or b.town + "city" == a.town or within(a.town, b.town, 1 if min(len(a.town), len(b.town)) < 6 else 2)
    if a.zip and b.zip:
        return False
    return bool(a.state and a.state == b.state)
