"""Names as people type them: readings of a name, and whether two names may mean one person."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

#: Formal given name -> short forms and nicknames. Fixed values.
NICKNAMES = {
    "abigail": "abby abbie gail", "albert": "al bert bertie", "alexander": "alex alec sandy xander alexr", "alfred": "al fred alfie", "alice": "ali", "amanda": "mandy", "andrew": "andy drew", "angela": "angie",
    "ann": "annie nan", "anthony": "tony ant", "arthur": "art artie", "barbara": "barb barbie babs", "benjamin": "ben benny benj", "bernard": "bernie barney", "beverly": "bev", "bradley": "brad",
    "caroline": "carrie caro", "catherine": "cathy kate katie cat kitty", "cecilia": "cece celia cissy", "charles": "charlie chuck chas chaz", "christina": "chris tina chrissy", "christine": "chris chrissy tina",
    "christopher": "chris kit topher", "clifford": "cliff", "cynthia": "cindy cyndi", "daniel": "dan danny danl", "david": "dave davey", "deborah": "deb debbie debby", "dennis": "denny den", "dolores": "lola",
    "donald": "don donny", "dorothy": "dot dottie dolly", "douglas": "doug", "edward": "ed eddie ted ned edw", "eleanor": "ellie nell nora ella", "elizabeth": "liz beth betsy betty eliza lizzie lisa", "emily": "em emmy", "estelle": "essie stella",
    "eugene": "gene", "florence": "flo florrie", "frances": "fran frannie", "francis": "frank fran", "franklin": "frank", "frederick": "fred freddie freddy fritz fredk rick", "gabrielle": "gabby gabi", "geoffrey": "jeff geoff", "george": "georgie geo", "gerald": "gerry jerry",
    "gilbert": "gil bert", "gregory": "greg", "gloria": "glo", "harold": "hal harry", "harriet": "hattie", "helen": "nell nellie", "henry": "hank harry hal", "herbert": "herb bert", "howard": "howie", "hugo": "hugh",
    "irene": "rene", "isabella": "izzy bella isa", "jacob": "jake", "jacqueline": "jackie jacqui", "james": "jim jimmy jamie jas", "janet": "jan", "jeffrey": "jeff", "jennifer": "jen jenny jenn", "jeremy": "jerry", "jessica": "jess jessie",
    "john": "jack johnny jon jno", "jonathan": "jon jonny", "joseph": "joe joey jos", "josephine": "jo josie", "joshua": "josh", "judith": "judy jude", "katherine": "kate kathy katie kat kay kath kitty", "kathleen": "kathy kath", "kenneth": "ken kenny", "kimberly": "kim kimmy",
    "lawrence": "larry lawrie", "leonard": "len lenny leo", "leroy": "roy", "lillian": "lil lily", "louis": "lou louie", "louise": "lou lulu", "lucille": "lucy lou", "luis": "lou", "margaret": "maggie meg peggy marge margie greta rita daisy margt", "maria": "mary mia",
    "martha": "marty patty", "martin": "marty", "matthew": "matt matty", "maximilian": "max", "megan": "meg", "melissa": "mel missy", "michael": "mike mick mickey mikey", "mildred": "millie", "mitchell": "mitch", "nancy": "nan",
    "naomi": "nomi", "natalie": "nat", "nathan": "nate nat", "nathaniel": "nate nat nathan", "nicholas": "nick nicky", "nicole": "nicky nikki", "oliver": "ollie", "olivia": "liv livvy", "oscar": "ozzie", "pamela": "pam pammy",
    "patricia": "pat patty trish tricia", "patrick": "pat paddy patk", "penelope": "penny pen", "peter": "pete", "philip": "phil pip", "phillip": "phil", "priscilla": "cilla", "quentin": "quent", "raymond": "ray", "rebecca": "becky becca", "reginald": "reg reggie",
    "richard": "rick dick rich richie ricky richd", "robert": "bob bobby rob robbie bert robt", "rodney": "rod", "roger": "rodge", "ronald": "ron ronny ronnie", "rosemary": "rose rosie", "russell": "russ", "samantha": "sam sammy", "samuel": "sam sammy saml",
    "sandra": "sandy", "sarah": "sally sadie", "sharon": "shari", "sofia": "sophie sofie", "stanley": "stan", "stephanie": "steph stevie", "stephen": "steve stevie", "steven": "steve stevie", "stuart": "stu", "susan": "sue susie suzy", "sylvia": "syl",
    "tamara": "tammy tam", "terence": "terry", "teresa": "terry tess tessa", "theodore": "ted teddy theo", "theresa": "terry tess", "thomas": "tom tommy thos", "timothy": "tim timmy", "ursula": "ursie", "valerie": "val", "vanessa": "nessa",
    "veronica": "ronnie vera roni", "victor": "vic", "victoria": "vicky vicki tori", "vincent": "vince vinny vin", "virginia": "ginny ginger", "vivian": "viv", "walter": "walt wally", "wanda": "wendy", "wilfred": "wilf will", "william": "bill billy will willy wm liam",
    "yvonne": "vonnie", "zachary": "zach zack zak",
}

#: Generation marks. Fixed values.
GENERATIONS = {"jr": "2", "junior": "2", "ii": "2", "2nd": "2", "sr": "1", "senior": "1", "iii": "3", "3rd": "3", "iv": "4", "4th": "4"}

FORMAL: dict[str, frozenset[str]] = {}
for _formal, _short in NICKNAMES.items():
    for _form in [_formal, *_short.split()]:
        FORMAL[_form] = FORMAL.get(_form, frozenset()) | {_formal}

_TITLE = re.compile(r"^(?:(?:mr|mrs|ms|miss|mx|dr|hon|honorable|atty|attorney|judge|prof|professor)\b\.?\s+)+")
_CREDENTIAL = re.compile(r"(?:\b(?:attorney|atty|lawyer|counsel(?:l?or)?)s? at law\b|[,\s]\s*(?:esq(?:uire)?|j\.?d|ll\.?m|ph\.?d|cpa|m\.?b\.?a)\b\.?)")
_PARTICLE = re.compile(r"\b(de la|de los|del|della|de|da|di|van der|van den|van|von|st|saint|mc|mac|le|la)[.\s]+(?=[a-z]{3})")
_CREDENTIALS = ("at law", "esq", "jd", "j.d", "llm", "ll.m", "phd", "ph.d", "cpa", "mba", "mb.a", "m.ba", "m.b.a")
_QUOTES, _STOPS, _OTHER, _LETTER = re.compile(r"['’`]"), re.compile(r"[\s.]+"), re.compile(r"[^a-z0-9-]"), re.compile("[a-z]")
LOOKALIKE = str.maketrans("0135", "oles")


def plain(text: str) -> str:
    """Lower case without accents, one space between words."""
    if text.isascii():
        return " ".join(text.lower().split())
    text = unicodedata.normalize("NFKD", text)
    return " ".join("".join(c for c in text if not unicodedata.combining(c)).lower().split())


def _words(text: str) -> list[str]:
    out = []
    for word in _STOPS.split(_QUOTES.sub("", text)):
        if not (word.isascii() and word.isalnum()):
            word = _OTHER.sub("", word).strip("-")
        if word:
            out.append(word)
    return out


def _untitled(text: str) -> str:
    m = _TITLE.match(text)
    return text[m.end() :] if m else text


@lru_cache(maxsize=50_000)
def readings(name: str | None) -> tuple[str, tuple[tuple[str, str, str], ...]]:
    """(generation, ((first, middle, last), ...)): the ways to read a typed name, the likeliest first.

    Titles and credentials go, a comma turns "Last, First" round, particles join the word behind them and look-alike
    digits become letters. Without a comma the last name may stand first, and the last two words may be one
    double name. A null, empty or letterless name has no readings.
    """
    if not name:
        return "", ()
    text = _untitled(plain(name))
    if any(mark in text for mark in _CREDENTIALS):
        text = _CREDENTIAL.sub(" ", " " + text)
    text = _untitled(text.strip(" ,"))
    generation = ""

    def strip_generation(words: list[str]) -> list[str]:
        nonlocal generation
        kept = []
        for i, word in enumerate(words):
            if word in GENERATIONS and (i or len(words) == 1):
                generation = generation or GENERATIONS[word]
            else:
                kept.append(word if word.isalpha() or not _LETTER.search(word) else word.translate(LOOKALIKE))
        return kept

    text = _PARTICLE.sub(lambda m: m.group(1).replace(" ", ""), text)
    parts = [strip_generation(_words(p)) for p in text.split(",")]
    parts = [p for p in parts if p]
    if not parts:
        return generation, ()
    found: list[tuple[str, str, str]] = []
    if len(parts) > 1:
        given = parts[1]
        found.append((given[0], " ".join(given[1:]), "".join(parts[0])))
    else:
        words = parts[0]
        if len(words) == 1:
            found.append(("", "", words[0]))
        else:
            straight = (words[0], " ".join(words[1:-1]), words[-1])
            turned = (words[1], " ".join(words[2:]), words[0])
            # A name does not end in an initial, so the last name must have come first.
            found += [turned] if len(words[-1]) == 1 else [straight, turned]
            if len(words) > 2 and len(words[-2]) > 3 and len(words[-1]) > 3:
                found.append((words[0], " ".join(words[1:-2]), words[-2] + words[-1]))
    # A double name may be typed in full, as one word, or with one half only.
    found = [(first.replace("-", ""), middle.replace("-", ""), last) for first, middle, last in found]
    halves = [(first, middle, half) for first, middle, last in found if "-" in last for half in last.split("-") if len(half) > 2]
    return generation, tuple(dict.fromkeys([(first, middle, last.replace("-", "")) for first, middle, last in found] + halves))


@lru_cache(maxsize=100_000)
def letter_bits(name: str) -> int:
    """Two bits a letter: whether it occurs, and whether more than once. An edit changes two bits at most, a swap none."""
    bits = 0
    for c in set(name):
        bits |= (3 if name.count(c) > 1 else 1) << 2 * (ord(c) % 31)
    return bits


def within(a: str, b: str, k: int) -> bool:
    """Whether the edit distance, a swap of neighbours counting as one edit, is at most ``k``; only a band of 2k + 1 is filled, and only
    where the letters are near enough."""
    if a == b:
        return True
    la, lb = len(a), len(b)
    if abs(la - lb) > k or k == 0 or (letter_bits(a) ^ letter_bits(b)).bit_count() > 2 * k:
        return False
    before: list[int] = []
    row = list(range(lb + 1))
    for i in range(1, la + 1):
        low, high = max(1, i - k), min(lb, i + k)
        new = [k + 1] * (lb + 1)
        if i <= k:
            new[0] = i
        best = new[0]
        x = a[i - 1]
        for j in range(low, high + 1):
            y = b[j - 1]
            d = row[j - 1] + (x != y)
            if row[j] + 1 < d:
                d = row[j] + 1
            if new[j - 1] + 1 < d:
                d = new[j - 1] + 1
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y and before[j - 2] + 1 < d:
                d = before[j - 2] + 1
            new[j] = d
            if d < best:
                best = d
        if best > k:
            return False
        before, row = row, new
    return row[lb] <= k


def edits_for(length: int) -> int:
    return 0 if length < 3 else 1 if length < 6 else 2


@lru_cache(maxsize=200_000)
def first_match(a: str, b: str) -> int:
    """3 equal or nickname, 2 typo, 1 initial or missing, 0 other person."""
    if not a or not b:
        return 1
    if a == b:
        return 3 if len(a) > 1 else 1
    if len(a) == 1 or len(b) == 1:
        long, short = (a, b) if len(a) > len(b) else (b, a)
        return 1 if short in {long[0], *(f[0] for f in FORMAL.get(long, ()))} or long[1:2] == short else 0
    fa, fb = FORMAL.get(a), FORMAL.get(b)
    if (fa or {a}) & (fb or {b}) if (fa or fb) else False:
        return 3
    # Two well-formed names that are both in the table are two names, however near.
    if a in NICKNAMES and b in NICKNAMES:
        return 0
    if within(a, b, edits_for(min(len(a), len(b)))) or a.replace("rn", "m") == b.replace("rn", "m"):
        return 2
    for x in fa or (a,):
        for y in fb or (b,):
            if within(x, y, edits_for(min(len(x), len(y)))):
                return 2
    return 0


_PREFIX = re.compile("(delos|dela|della|del|vander|vanden|van|von|mc|mac|de|di|da|st|la|le|o)(?=.{4})")


@lru_cache(maxsize=100_000)
def bare(last: str) -> str:
    """A last name without its particle, and with "rn" for what may be an "m"."""
    m = _PREFIX.match(last)
    return (last[m.end() :] if m else last).replace("rn", "m")


@lru_cache(maxsize=200_000)
def last_match(a: str, b: str) -> int:
    """2 equal, 1 typo, 0 other name."""
    if a == b:
        return 2
    if within(a, b, edits_for(min(len(a), len(b)))):
        return 1
    x, y = bare(a), bare(b)
    return 1 if (x != a or y != b) and within(x, y, edits_for(min(len(x), len(y)))) else 0


def middle_conflict(a: str, b: str) -> bool:
    if not a or not b or a[0] == b[0]:
        return False
    if len(a) > 1 and len(b) > 1 and within(a, b, 2):
        return False
    return not (len(a) > 1 and a[1:2] == b[:1] or len(b) > 1 and b[1:2] == a[:1])


def written(name: str | None) -> str:
    """All readings of a name as one text, "generation;first,middle,last;...": made once a name, compared many times."""
    generation, found = readings(name)
    return ";".join([generation, *[",".join(r) for r in found]])


@lru_cache(maxsize=50_000)
def _unwritten(text: str) -> tuple[str, tuple[tuple[str, ...], ...]]:
    generation, *found = text.split(";")
    return generation, tuple(tuple(r.split(",")) for r in found)


def name_match(a: str | None, b: str | None) -> int:
    """How well two typed names agree: 0 other persons, 1 by initials only, 2 with typos, 3 fully."""
    return written_match(written(a), written(b))


@lru_cache(maxsize=100_000)
def written_match(a: str, b: str) -> int:
    """``name_match`` of two ``written`` names."""
    ga, ra = _unwritten(a)
    gb, rb = _unwritten(b)
    if ga and gb and ga != gb:
        return 0
    best = 0
    for fa, ma, la in ra:
        for fb, mb, lb in rb:
            last = last_match(la, lb)
            if not last or middle_conflict(ma, mb):
                continue
            first = first_match(fa, fb)
            if not first and (not ma and mb and first_match(fa, mb.split()[0]) or not mb and ma and first_match(fb, ma.split()[0])):
                first = 1  # known by the middle name
            if first and (score := min(first, last + 1)) > best:
                best = score
                if best == 3:
                    return best
    return best


def likely_middle(text: str) -> str:
    """The middle name of the likeliest reading of a ``written`` name."""
    found = _unwritten(text)[1]
    return found[0][1] if found else ""


def last_names(name: str | None) -> tuple[list[str], list[str]]:
    """(single, double): the last names that a name is looked up by.

    Single ones are that of the likeliest reading, and those of the others that are no given name. Double ones join the last two words; they
    only have to meet the same name typed as one word, since two names typed as two words meet by the last one.
    """
    read = readings(name)[1]
    double = {middle.split()[-1] + last for _, middle, last in read[:1] if middle}
    single = {last for i, (_, _, last) in enumerate(read) if last and (not i or last not in FORMAL)}
    return sorted(single - double), sorted(double & {last for _, _, last in read})
