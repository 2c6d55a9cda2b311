"""Template residue and error-page text in text values.

A value is cut into messages (sentences; a link is one message). A prefix tree of fixed depth, with the number of words at
its root and the first words below, groups the messages. A leaf has one template: at each position the word that at least half of its
messages have, and a wildcard where none has. Messages that follow it, up to typing errors in its words, are written as the template;
each template is classified once and the verdict goes back to every value with such a message. Unresolved slots are looked for in all
values, ordinary ones too.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossier.session import cut_lineage

#: Words of a message that are levels of the tree; share of a leaf's messages that makes a word part of its template.
DEPTH, SHARE = 3, 0.5

# --- slots ---------------------------------------------------------------------------------------------------------
_SLOT_WORD = r"(?:full|first|last|middle|given|family|your|insert|enter|attorney|lawyer|client|user|person|profile|firm|company|practice|law|school|college|city|town|state|zip|years?|date|age|bio|biography|about|description|text|content|photo|image|picture|portrait|avatar|slug|id|uuid|name|title|phone|email|address|url|link|placeholder|tbd|todo|number|here|area)"
SLOT = re.compile(
    r"\{\{[^{}]*\}\}|\$\{[^{}]*\}|#\{[^{}]*\}|\{%[^%]*%\}|<%.*?%>|&lt;%.*?%&gt;|\{[A-Za-z_][\w .-]*\}|\{\d+\}"
    r"|@@[^@]+@@|\*\|[^|]*\|\*|%[A-Za-z]+(?:[_.][A-Za-z]+)*%|(?<![\w%])%(?:s|d|\d\$s|\(\w+\)s)(?!\w)|__[A-Za-z][A-Za-z ]*(?:_[A-Za-z]+)*__|%7[Bb].*?%7[Dd]|\[\[[^\[\]]*\]\]"
    rf"|[\[<]\s*{_SLOT_WORD}(?:[\s_.-]*{_SLOT_WORD})*\s*[\]>]|\[\s*(?:insert|enter|add|your)\b[^\]]*\]"
    rf"|&lt;\s*{_SLOT_WORD}(?:[\s_.-]*{_SLOT_WORD})*\s*&gt;"
    r"|\bMISSING_TRANSLATION\b|\[object \w+\]",
    re.I,
)
_NO_OBJECT = re.compile(r"(?:^|[\s(/=-])(?:undefined|null|NaN)(?=$|[\s).,/&-])")

# --- classes of messages -------------------------------------------------------------------------------------------
_THING = r"(?:page|profile|listing|link|record|resource|document|file|site|service|server|content|lawyer you asked for|attorney you asked for|entry|account|item|url|address you entered)"
_ERROR = [
    rf"\b(?:the|this|that|your|our|requested) {_THING}s?\b.{{0,40}}\b(?:no longer exists?|no longer (?:here|available)|(?:does|do|did) not (?:exist|answer|respond|load)|could not be (?:found|loaded|shown|displayed|reached)|cannot be (?:found|loaded|shown|displayed)|not (?:be )?(?:found|available)|failed to load|has (?:moved|expired|been (?:removed|deleted|moved|blocked|disabled|suspended))|was (?:removed|taken down|deleted|moved|not found)|were removed|is (?:hidden|unavailable|down|gone|offline|not available|private|out of date)|timed out)",
    r"\bpage (?:could )?not (?:be )?found\b|\bthe page you (?:wanted|requested|are looking for|asked for)\b|\bla pagina solicitada\b|\bpagina no (?:existe|encontrada)\b|\bpage introuvable\b",
    r"^(?:your |this |the )?(?:request|query|session|access|connection|login|permission|service|server|token|operation|upload|download) (?:was |has been |has |is |were )?(?:denied|rejected|blocked|expired|refused|reset|forbidden|failed|closed|lost|limit|timed? ?out|timeout|unavailable|not allowed|limited|terminated)\b",
    r"^(?:an? |the |fatal |internal |server |unknown |http )*(?:error|errors?|exception|warning|notice|status|code|http)\b[:\s-]*(?:code |status )?<n>",
    r"\b(?:http|error|status|code|err)[\s:#-]*<n>|^<n>\s*[-:|]\s*\w|\(<n>\)$",
    r"\btraceback\b.*\bcall\b|\b(?:key|type|value|name|syntax|reference|attribute)error\b|\bfatal error\b|\bundefined (?:index|variable|offset|property)\b|\bunexpected token\b|\bnull ?pointer\b|\bstack ?trace\b|\bcall to a member\b|\bon line <n>|\bbad gateway\b|\bgateway time-?out\b|\binternal server error\b|\bservice unavailable\b",
    r"\btoo many requests\b|\brate limit\b|^slow down$|\b(?:try|search) (?:again|later)\b|\btry your search again\b|\bwait and retry\b|\bcontact the (?:site owner|administrator|webmaster)\b|\bback to the home ?page\b|\bsomething (?:broke|went wrong)\b|^oops\b|\bplease return soon\b|\bdown for (?:upkeep|maintenance)\b|\b(?:do|does) not have (?:permission|access)\b|\b(?:not|un)authori[sz]ed\b to\b|\bsign in (?:again|to)\b|\blog ?in (?:again|to (?:view|see|continue))\b|\bserver did not answer\b|\bhas not been claimed\b",
]
_SCRIPT = [
    r"\b(?:enable|enabling|activate|activer|allow|turn on|switch on|turn|habilite|habilitar|active|activar|aktivieren|require[sd]?|needs?)\b.{0,25}\b(?:javascript|java script|js|scripts?|scripting|cookies)\b",
    r"\b(?:javascript|js|scripts?|scripting|cookies)\b.{0,25}\b(?:is|are|must be|be|was|were|has been)\s+(?:disabled|enabled|allowed|required|blocked|off|turned (?:on|off)|switched (?:on|off)|activated|needed)\b",
    r"\bcookies? to (?:improve|run|work|make|give|offer|serve)\b|\baccept (?:all|cookies)\b|\bmanage (?:choices|cookies|preferences)\b|\bad ?block(?:er)?\b|\bbrowser is (?:out of date|not supported|too old)\b",
    r"\bnot a robot\b|\byou are (?:a )?human\b|\bcaptcha\b|\bcomplete the puzzle\b|\bchecking your browser\b|^(?:page |content |profile )?(?:is )?loading\b|\bone moment\b",
]
_FILLER = [
    r"\b(?:lorem|ipsum)\b.{0,30}\b(?:dolor|ipsum|sit|amet)\b|\b(?:consectetur|adipiscing|eiusmod|incididunt)\b",
    r"\bcoming soon\b|\b(?:to be (?:written|added|determined|announced|completed|supplied))\b|\bto follow$|\bnot yet (?:supplied|written|available|added|provided)\b|\bhas been supplied yet\b|\b(?:goes|go) here\b|\bwill be (?:added|supplied|updated|provided)(?: shortly| soon)?$",
    r"^(?:(?:your|attorney|lawyer|profile|about|the) )?(?:bio|biography|description|story|summary|text|section|profile|attorney summary|profile text|about section)\b.{0,12}(?:pending|under construction|placeholder|missing|empty|unavailable)$",
    r"\bsample (?:profile |bio(?:graphy)? )?text\b|\breplace (?:it|this) with your own\b|^(?:click|tap) (?:here )?to edit\b|^(?:enter|add|insert|type|write) (?:an? |your |the |some )?(?:attorney |lawyer |profile |short |few )?(?:bio|biography|description|text|story|summary|lines|words)\b|\bwrite a few lines about yourself\b|\bplaceholder text\b",
    r"^(?:#(?:ref|value|name|div/0|n/a|null|num)[!?]?|n/?a|tbd|tba|todo|none|nil|null|nan|undefined|string|bio|test|\(not set\)|no (?:bio|biography|description|data|information|text)(?: (?:available|provided|found|given))?)$",
    r"\bwindow\.\w+|\bfunction\s*\(|^\w+(?:\.\w+){2,}$|\bvar \w+ ?=|&nbsp;|\\u<n>|\\u0+|</?(?:html|head|title|body|noscript|script|iframe|div)\b",
]
RESIDUE = [("error", [re.compile(p) for p in _ERROR]), ("script", [re.compile(p) for p in _SCRIPT]), ("filler", [re.compile(p) for p in _FILLER])]
_FILLER_WORDS = frozenset("lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip foo bar baz qux dummy filler sample test text words word goes here more etc asdf blah placeholder example".split())
_CUE_WORDS = frozenset("javascript js error status http access request query session connection page profile listing link record resource please enable this the your our that sorry oops biography bio description loading wait try content service site we you verify checking complete accept contact slow too something no not".split()) | _FILLER_WORDS
_TAG = re.compile(r"<(?!%)/?[a-z]*(?:\s[^<>]*)?>", re.I)
_SENTENCE = re.compile(r"(?<=[.!?])\s+|[\n\r]+|<br\s*/?>|</p>", re.I)
_WORD = re.compile(r"<[xn*]>|[^\W_]+(?:['’][^\W_]+)*|[^\w\s]", re.U)

# --- links ---------------------------------------------------------------------------------------------------------
_LINK = re.compile(r"^(https?)://([^/?#\s]+)/([^?#]*)(?:\?([^#]*))?(?:#.*)?$", re.I)
_ABSENT = "no not default generic blank empty missing unknown anonymous anon dummy placeholder stub spacer loading coming soon unavailable none null nil undefined nobody noone silhouette mystery your here sample test transparent pixel untitled unassigned notfound na temp dflt example fallback invalid broken error"
_PORTRAIT = "photo photos picture pic image images img avatar user person people profile portrait headshot head face man woman male female icon thumb thumbnail available found lawyer attorney member logo upload gravatar account contact human body shot file media set yet to and the a is of for on"
_ABSENT_WORDS, _NAME_PARTS = frozenset(_ABSENT.split()), frozenset(_ABSENT.split()) | frozenset(_PORTRAIT.split())
_ENDPOINTS = frozenset("error errors login signin sign-in logout challenge captcha blocked forbidden denied 404 403 500 maintenance".split())


@lru_cache(maxsize=20_000)
def _parts_of_name(name: str) -> frozenset[str] | None:
    """The words that a file name consists of, all of them about portraits or their absence; else null."""
    words: set[str] = set()
    for run in re.findall(r"[a-z]+", name):
        if re.fullmatch("[a-z]|px|sm|md|lg|xl|large|small|medium|big|tiny|retina|square|round", run) and len(name) > len(run):
            continue
        best: list[frozenset[str] | None] = [frozenset()] + [None] * len(run)
        for end in range(1, len(run) + 1):
            for start in range(max(0, end - 12), end):
                if best[start] is not None and run[start:end] in _NAME_PARTS:
                    best[end] = best[start] | {run[start:end]}
                    break
        if best[len(run)] is None:
            return None
        words |= best[len(run)]
    return frozenset(words)


def classify_link(link: str) -> str:
    """"residue" for a link that leads to no portrait, "" for others."""
    m = _LINK.match(link.strip())
    if not m or re.search(r"\s", link.strip()):
        return "residue"
    host, path, query = m.group(2).lower(), m.group(3), m.group(4) or ""
    if SLOT.search(link) or _NO_OBJECT.search("/" + path) or re.search(r"=(?:undefined|null|nan)\b", query, re.I) or re.search(r"\[[^\]]*\]", path):
        return "residue"
    segments = [s for s in path.lower().split("/") if s]
    if not segments or any(s in _ENDPOINTS for s in segments) or segments[-1].endswith((".html", ".htm", ".php", ".aspx")):
        return "residue"
    last = segments[-1]
    if re.fullmatch(r"\d+x\d+", last) and len(segments) > 1:
        last = segments[-2]
    words = _parts_of_name(last.rpartition(".")[0] or last)
    if words is not None and (words & _ABSENT_WORDS):
        return "residue"
    return "residue" if host.split(".")[0] in ("example", "localhost", "placeholder") and words is not None else ""


# --- messages ------------------------------------------------------------------------------------------------------
def split_messages(text: str) -> list[str]:
    return [m for m in (m.strip() for m in _SENTENCE.split(text)) if m]


def mask(message: str, own: frozenset[str]) -> list[str]:
    """The words of a message in lower case: numbers as <n>; the record's own names, and capitalised words behind the first, as <x>."""
    shouting = message.upper() == message
    out: list[str] = []
    for i, word in enumerate(_WORD.findall(message)):
        low = word.lower()
        if word[0].isdigit():
            low = "<n>"
        elif low in own or (i and not shouting and word[:1].isupper() and low not in _CUE_WORDS):
            low = "<x>"
        if low != "<x>" or not out or out[-1] != "<x>":
            out.append(low)
    return out


def is_prose(words: list[str]) -> bool:
    return sum(w[0].isalpha() or w == "<x>" for w in words) >= 5


def classify_message(template: str) -> str:
    """"error", "script", "filler", "prose" or "short" (no sentence)."""
    text = re.sub(r"\s+([.,;:!?)\]])", r"\1", template)
    text = re.sub(r"([(\[#&\\<])\s+", r"\1", text).strip(" .!,;:-")
    bare = re.sub(r"\s*(?:[-(\[#]+\s*)?(?:error|code|status)?\s*<n>[)\]]*$", "", text).strip(" .!,;:-([#") or text
    for kind, patterns in RESIDUE:
        if any(p.search(text) or p.search(bare) for p in patterns):
            return kind
    words = [w for w in template.split() if w[0].isalpha()]
    if len(words) >= 4 and sum(w in _FILLER_WORDS for w in words) >= 0.6 * len(words):
        return "filler"
    return "prose" if is_prose(template.split()) else "short"


MESSAGE = "id long, column_name string, at int, leaf long, masked string, slot boolean"


def _messages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for r in batch.itertuples(index=False):
            own = frozenset(w for field in (r.full_name, r.first_name, r.last_name, r.firm_name, r.city) if field for w in re.findall(r"[^\W\d_]{4,}", field.lower()) if w not in _CUE_WORDS)
            if r.bio is not None and r.bio.strip():
                slot = bool(SLOT.search(r.bio) or _NO_OBJECT.search(r.bio))
                plain = _TAG.sub(" ", r.bio) if not re.search(r"<(?:html|noscript|script|iframe)", r.bio, re.I) else r.bio
                found = split_messages(plain) or [r.bio.strip()]
                for i, message in enumerate(found):
                    words = mask(message, own) or ["<empty>"]
                    leaf = hash_path(len(words), words[:DEPTH])
                    rows.append((r.id, "bio", i, leaf, " ".join(words), slot))
            if r.photo_url is not None and r.photo_url.strip():
                rows.append((r.id, "photo_url", 0, 0, re.sub(r"(%[0-9A-Fa-f]{2})|\d+", lambda m: m.group(1) or "0", r.photo_url.strip()), False))
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in MESSAGE.split(", ")])


def hash_path(n: int, words: list[str]) -> int:
    """A leaf of the tree as a number that is the same on every executor."""
    import xxhash

    return xxhash.xxh64_intdigest(f"{n} {' '.join(words)}") >> 1


def _verdicts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        kinds = [classify_message(t) if c == "bio" else classify_link(t) for c, t in zip(batch.column_name, batch.text)]
        yield pd.DataFrame({"column_name": batch.column_name, "text": batch.text, "verdict": kinds})


def _follows(word: Column, of_template: Column) -> Column:
    """The template's word, any word at a wildcard, or the word with a typing error (two in long words)."""
    edits = F.when(F.length(of_template) < 5, 0).when(F.length(of_template) < 9, 1).otherwise(2)
    typed = ~of_template.startswith("<") & ~word.startswith("<") & (F.levenshtein(word, of_template) <= edits)
    return (word == of_template) | (of_template == "<*>") | typed


def mine_templates(masked: DataFrame) -> DataFrame:
    """(column_name, leaf, masked, template) of distinct masked messages ``masked(column_name, leaf, masked, n)``.

    Words of a leaf are counted per (leaf, position), never gathered; a template is as long as its messages. Where a template has a wildcard,
    cue words stay and others become <x>. A message that does not follow its leaf's template is its own; so is a link.
    """
    bio = masked.where("column_name = 'bio'")
    words = bio.select("leaf", "n", F.posexplode(F.split("masked", " ")).alias("pos", "word"))
    counted = words.groupBy("leaf", "pos", "word").agg(F.sum("n").alias("n"))
    common = counted.groupBy("leaf", "pos").agg(F.max_by("word", F.struct("n", "word")).alias("word"), F.max("n").alias("most"), F.sum("n").alias("all"))
    shown = F.when(F.col("most") >= SHARE * F.col("all"), F.col("word")).otherwise("<*>")
    of_leaf = common.groupBy("leaf").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", shown.alias("word")))), lambda x: x["word"]).alias("of_leaf"))
    keep = F.array(*[F.lit(w) for w in sorted(_CUE_WORDS)])
    both = F.arrays_zip(F.split("masked", " ").alias("word"), F.col("of_leaf").alias("t"))
    follows = F.forall(both, lambda x: _follows(x["word"], x["t"]))
    written = F.array_join(F.transform(both, lambda x: F.when(x["t"] != "<*>", x["t"]).when(F.array_contains(keep, x["word"]), x["word"]).otherwise("<x>")), " ")
    mined = bio.join(of_leaf, "leaf").select("column_name", "leaf", "masked", F.when(follows, written).otherwise(F.col("masked")).alias("template"))
    return mined.unionByName(masked.where("column_name = 'photo_url'").select("column_name", "leaf", "masked", F.col("masked").alias("template")))


#: Verdicts that are none.
CLEAN = ["prose", "short", ""]


def judged_messages(profiles: DataFrame) -> DataFrame:
    """(id, column_name, slot, masked, template, by_template, verdict): every message of every bio and photo_url.

    The verdict is that of the template, if that is residue, else that of the message itself, whose words the template may have left out.
    """
    rows = profiles.where("id is not null and (bio is not null or photo_url is not null)").select("id", "bio", "photo_url", "full_name", "first_name", "last_name", "firm_name", "city")
    messages = cut_lineage(rows.mapInPandas(_messages, MESSAGE))
    distinct = cut_lineage(messages.groupBy("column_name", "leaf", "masked").agg(F.count("*").alias("n")))
    mined = cut_lineage(mine_templates(distinct))
    texts = mined.select("column_name", F.explode(F.array_distinct(F.array("template", "masked"))).alias("text")).distinct()
    verdicts = cut_lineage(texts.mapInPandas(_verdicts, "column_name string, text string, verdict string"))
    named = lambda text, verdict: verdicts.select("column_name", F.col("text").alias(text), F.col("verdict").alias(verdict))
    told = mined.join(named("template", "v1"), ["column_name", "template"]).join(named("masked", "v2"), ["column_name", "masked"])
    by_template = ~F.col("v1").isin(CLEAN)
    told = told.select("column_name", "leaf", "masked", "template", (by_template & F.col("v2").isin(CLEAN)).alias("by_template"), F.when(by_template, F.col("v1")).otherwise(F.col("v2")).alias("verdict"))
    return messages.join(told, ["column_name", "leaf", "masked"]).select("id", "column_name", "slot", "masked", "template", "by_template", "verdict")


def residue_values(profiles: DataFrame) -> DataFrame:
    """(id, column_name, reason) of each bio or photo_url that is template, filler or error text wholly or in part.

    Null and blank values are no cases. reason is "slot", "error", "script", "filler", "residue" (links) or "short": no
    message of the value is a sentence.
    """
    bad = F.when(~F.col("verdict").isin(CLEAN), F.col("verdict"))
    values = judged_messages(profiles).groupBy("id", "column_name").agg(F.max("slot").alias("slot"), F.max(bad).alias("bad"), F.max(F.col("verdict").isin("prose", "")).alias("prose"))
    reason = F.when(F.col("slot"), "slot").when(F.col("bad").isNotNull(), F.col("bad")).when(~F.col("prose"), "short")
    return values.select("id", "column_name", reason.alias("reason")).where("reason is not null")


def template_report(profiles: DataFrame) -> DataFrame:
    """(column_name, verdict, templates, messages, rows, rows_by_template): how many templates and wordings have each verdict, the values with
    such a message, and those of them that only the template, and not the wording of their own, gives away."""
    per = judged_messages(profiles).groupBy("column_name", "verdict")
    by_template = F.count_distinct(F.when(F.col("by_template"), F.col("id"))).alias("rows_by_template")
    return per.agg(F.count_distinct("template").alias("templates"), F.count_distinct("masked").alias("messages"), F.count_distinct("id").alias("rows"), by_template)
