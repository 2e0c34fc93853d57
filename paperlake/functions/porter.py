"""English word stems by the published Porter2 (Snowball English) rules, as column expressions on arrays of words.

Each step of the algorithm is one `transform` over the array, so an element is computed once and then referred to
as often as a rule needs it. The state of a word is struct(x, w, p1, p2, done): the word as given, what is left of it, where
its regions R1 and R2 begin (places, as suffixes go the regions stay), and its stem if an exception has fixed that.
Consonant y is written Y between the first and the last step.

`english_stem` says the same of one word in plain Python, for texts whose many words are few different ones (tokens.forms).
"""

import re
from collections.abc import Callable, Mapping
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: the published rules -----------------------------------------
EXCEPTIONS = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl",
    "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl", "sky": "sky", "news": "news", "howe": "howe",
    "atlas": "atlas", "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
AFTER_PLURALS = ("inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed")
WHOLE_PREFIXES = ("gener", "commun", "arsen")
STEP_2 = {
    "ational": "ate", "fulness": "ful", "iveness": "ive", "ization": "ize", "ousness": "ous", "biliti": "ble", "lessli": "less",
    "tional": "tion", "alism": "al", "aliti": "al", "ation": "ate", "entli": "ent", "fulli": "ful", "iviti": "ive", "ousli": "ous",
    "abli": "able", "alli": "al", "anci": "ance", "ator": "ate", "enci": "ence", "izer": "ize", "bli": "ble", "ogi": "og", "li": "",
}
STEP_3 = {
    "ational": "ate", "tional": "tion", "alize": "al", "icate": "ic", "iciti": "ic", "ative": "", "ical": "ic", "ness": "", "ful": "",
}
STEP_4 = "ement ance ence able ible ment ant ent ism ate iti ous ive ize ion al er ic".split()
DOUBLES = "bb|dd|ff|gg|mm|nn|pp|rr|tt"

_TO_REGION = "^.*?[aeiouy][^aeiouy]"
#: A vowel between a consonant and a consonant other than w, x and Y; or a vowel and a consonant that are the whole word.
SHORT_SYLLABLE = "([^aeiouy][aeiouy][^aeiouywxY]|^[aeiouy][^aeiouy])$"


def _set(state: Column, **fields: Column) -> Column:
    return F.struct(*[fields.get(name, state[name]).alias(name) for name in ("x", "w", "p1", "p2", "done")])


def _cut(word: Column, n: int | Column) -> Column:
    return F.substr(word, F.lit(1), F.length(word) - n)


def _choose(found: Column, values: Mapping[str, str]) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), found)


def _region(word: Column) -> Column:
    """Where the region behind the first vowel that a consonant follows begins; the length of the word if there is none."""
    before = F.length(F.regexp_extract(word, _TO_REGION, 0))
    return F.when(before > 0, before).otherwise(F.length(word))


def _start(x: Column) -> Column:
    fixed = F.when(F.length(x) <= 2, x).otherwise(_choose(x, EXCEPTIONS))
    marked = F.regexp_replace(F.regexp_replace(x, "^y", "Y"), "([aeiouy])y", "$1Y")
    return F.struct(x.alias("x"), marked.alias("w"), F.lit(0).alias("p1"), F.lit(0).alias("p2"), fixed.alias("done"))


def _regions(s: Column) -> Column:
    prefix = F.length(F.regexp_extract(s["w"], f"^({'|'.join(WHOLE_PREFIXES)})", 0))
    return _set(s, p1=F.when(prefix > 0, prefix).otherwise(_region(s["w"])))


def _second_region(s: Column) -> Column:
    return _set(s, p2=s["p1"] + _region(F.substr(s["w"], s["p1"] + 1)))


def _plurals(s: Column) -> Column:
    w = s["w"]
    out = (
        F.when(w.rlike("sses$"), _cut(w, 2))
        .when(w.rlike("ie[ds]$"), F.when(F.length(w) > 4, _cut(w, 2)).otherwise(_cut(w, 1)))
        .when(w.rlike("[us]s$"), w)
        .when(w.rlike("[aeiouy].+s$"), _cut(w, 1))
        .otherwise(w)
    )
    return _set(s, w=out)


def _after_plurals(s: Column) -> Column:
    return _set(s, done=F.coalesce(s["done"], F.when(s["w"].isin(*AFTER_PLURALS), s["w"])))


def _participles(s: Column) -> Column:
    """Endings of step 1b; a word that lost one is marked by a blank in front, for the repairs that follow."""
    w = s["w"]
    long = F.regexp_extract(w, "eed(ly)?$", 0)
    gone = F.regexp_replace(w, "(ingly|edly|ing|ed)$", "")
    in_region = F.length(w) - F.length(long) >= s["p1"]
    out = (
        F.when(long != "", F.when(in_region, F.concat(_cut(w, F.length(long)), F.lit("ee"))).otherwise(w))
        .when(w.rlike("[aeiouy].*(ingly|edly|ing|ed)$"), F.concat(F.lit(" "), gone))
        .otherwise(w)
    )
    return _set(s, w=out)


def _repairs(s: Column) -> Column:
    v = F.substr(s["w"], F.lit(2))
    short = (F.length(v) <= s["p1"]) & v.rlike(SHORT_SYLLABLE)
    mended = F.when(v.rlike("(at|bl|iz)$") | short, F.concat(v, F.lit("e"))).when(v.rlike(f"({DOUBLES})$"), _cut(v, 1)).otherwise(v)
    return _set(s, w=F.when(s["w"].startswith(" "), mended).otherwise(s["w"]))


def _final_y(s: Column) -> Column:
    return _set(s, w=F.regexp_replace(s["w"], "^(.+[^aeiouy])[yY]$", "$1i"))


def _suffix(region: str, endings: Mapping[str, str], allowed: Callable[[Column, Column, Column], Column]) -> Callable[[Column], Column]:
    """Replace the longest of the endings where it lies in a region and is allowed: `allowed(state, ending, rest)`."""
    pattern = f"({'|'.join(sorted(endings, key=len, reverse=True))})$"

    def step(s: Column) -> Column:
        ending = F.regexp_extract(s["w"], pattern, 1)
        rest = _cut(s["w"], F.length(ending))
        fits = (ending != "") & (F.length(rest) >= s[region]) & allowed(s, ending, rest)
        return _set(s, w=F.when(fits, F.concat(rest, _choose(ending, endings))).otherwise(s["w"]))

    return step


def _last(s: Column) -> Column:
    w, rest = s["w"], _cut(s["w"], 1)
    e = w.endswith("e") & ((F.length(rest) >= s["p2"]) | ((F.length(rest) >= s["p1"]) & ~rest.rlike(SHORT_SYLLABLE)))
    double = w.endswith("ll") & (F.length(rest) >= s["p2"])
    return _set(s, w=F.when(e | double, rest).otherwise(w))


STEPS: tuple[Callable[[Column], Column], ...] = (
    _regions,
    _second_region,
    _plurals,
    _after_plurals,
    _participles,
    _repairs,
    _final_y,
    _suffix("p1", STEP_2, lambda s, e, rest: ((e != "li") | rest.rlike("[cdeghkmnrt]$")) & ((e != "ogi") | rest.endswith("l"))),
    _suffix("p1", STEP_3, lambda s, e, rest: (e != "ative") | (F.length(rest) >= s["p2"])),
    _suffix("p2", dict.fromkeys(STEP_4, ""), lambda s, e, rest: (e != "ion") | rest.rlike("[st]$")),
    _last,
)


def english_stems(words: Column) -> Column:
    """The stems of an array of lower-case words, in the same order."""
    states = F.transform(words, _start)
    for step in STEPS:
        states = F.transform(states, step)
    return F.transform(states, lambda s: F.coalesce(s["done"], F.translate(s["w"], "Y", "y")))


# --- word by word --------------------------------------------------------------
#: Different words whose forms a Python worker remembers.
REMEMBERED = 1 << 17
_VOWEL_LATER = re.compile("[aeiouy].+s$")
_PARTICIPLE, _GONE = re.compile("[aeiouy].*(ingly|edly|ing|ed)$"), re.compile("(ingly|edly|ing|ed)$")
_SHORT, _DOUBLED = re.compile(SHORT_SYLLABLE), re.compile(f"({DOUBLES})$")
_REGION, _PREFIX = re.compile(_TO_REGION), re.compile(f"({'|'.join(WHOLE_PREFIXES)})")


def _region_of(w: str) -> int:
    found = _REGION.match(w)
    return found.end() if found else len(w)


def _without(w: str, start: int, endings: Mapping[str, str], allowed: Callable[[str, str], bool]) -> str:
    ending = next((e for n in range(min(7, len(w)), 0, -1) if (e := w[-n:]) in endings), None)
    if ending is None:
        return w
    rest = w[: -len(ending)]
    return rest + endings[ending] if len(rest) >= start and allowed(ending, rest) else w


_FOUR = dict.fromkeys(STEP_4, "")


@lru_cache(REMEMBERED)
def english_stem(word: str) -> str:
    """The stem of one lower-case word, by the steps above."""
    if len(word) <= 2 or word in EXCEPTIONS:
        return EXCEPTIONS.get(word, word)
    w = re.sub("([aeiouy])y", r"\1Y", re.sub("^y", "Y", word))
    prefix = _PREFIX.match(w)
    p1 = prefix.end() if prefix else _region_of(w)
    p2 = p1 + _region_of(w[p1:])
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith(("ied", "ies")):
        w = w[:-2] if len(w) > 4 else w[:-1]
    elif not w.endswith(("us", "ss")) and _VOWEL_LATER.search(w):
        w = w[:-1]
    if w in AFTER_PLURALS:
        return w
    long = "eedly" if w.endswith("eedly") else "eed" if w.endswith("eed") else ""
    if long:
        w = w[: -len(long)] + "ee" if len(w) - len(long) >= p1 else w
    elif _PARTICIPLE.search(w):
        w = _GONE.sub("", w)
        if w.endswith(("at", "bl", "iz")) or (len(w) <= p1 and _SHORT.search(w)):
            w += "e"
        elif _DOUBLED.search(w):
            w = w[:-1]
    if len(w) > 2 and w[-1] in "yY" and w[-2] not in "aeiouy":
        w = w[:-1] + "i"
    w = _without(w, p1, STEP_2, lambda e, rest: (e != "li" or rest[-1:] in tuple("cdeghkmnrt")) and (e != "ogi" or rest.endswith("l")))
    w = _without(w, p1, STEP_3, lambda e, rest: e != "ative" or len(rest) >= p2)
    w = _without(w, p2, _FOUR, lambda e, rest: e != "ion" or rest.endswith(("s", "t")))
    n = len(w) - 1
    if (w.endswith("e") and (n >= p2 or (n >= p1 and not _SHORT.search(w[:-1])))) or (w.endswith("ll") and n >= p2):
        w = w[:-1]
    return w.replace("Y", "y")
