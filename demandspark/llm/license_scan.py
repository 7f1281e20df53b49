"""License scan with ordered signature rules, as DataFrame functions only.

Texts are lower-cased and cut into words. A cheap substring gate leaves out the
texts that no rule can match. In the rest, each rule of which a keyword occurs
is matched as a regular expression over the blank-joined words; every match of a
rule holds one of its keywords, whole words or parts of three letters at least.
Detections are word intervals. In order of start, then longest, then priority, an interval inside an
accepted one is suppressed, and one that partly overlaps it stays only if its
rule comes before. Four base phrases are reported wherever they stand.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.llm.common import full_text

# The base phrases with their labels, and the bytes between words.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
GAP = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    keywords: tuple[str, ...]   # parts of the blank-joined words; every match, with the blanks around it, holds one
    pattern: str                # over blank-joined words
    label: str
    score: float                # how sure a detection is


# How a license is named: grant texts are surer than mentions.
_GRANT = "(?:licensed|released|distributed|available|provided|published|covered|governed|made available)" \
         "(?: \\S+){0,3}? (?:under|by|with)(?: the)?(?: terms of)?(?: the)?"
_VERSION = "(?: (?:version|v|ver))?"


def _versions(name: str, label: str, versions: tuple[str, ...], *keywords: str) -> list[Rule]:
    """Rules of a license family: each version with and without a grant, then the bare name."""
    out = []
    for v in versions:
        number = v.replace(".", " ")
        tail = f"{_VERSION} {number}|{_VERSION} {number.split()[0]}" if number.endswith(" 0") else f"{_VERSION} {number}"
        out.append(Rule(keywords, f"{_GRANT} (?:{name})(?:{tail})(?: or(?: any)? later(?: version)?)", f"{label}-{v}-or-later", 1.0))
        out.append(Rule(keywords, f"{_GRANT} (?:{name})(?:{tail})", f"{label}-{v}", 1.0))
        out.append(Rule(keywords, f"(?:{name})(?:{tail})", f"{label}-{v}", 0.9))
    out.append(Rule(keywords, f"{_GRANT} (?:{name})", label, 0.9))
    out.append(Rule(keywords, f"(?:{name})", label, 0.7))
    return out


def _rules() -> list[Rule]:
    """The signature rules in order of priority."""
    out: list[Rule] = []
    # machine-readable tags first
    tags = {"mit": "mit", "apache 2 0": "apache-2.0", "isc": "isc", "bsd 2 clause": "bsd-2-clause",
            "bsd 3 clause": "bsd-3-clause", "mpl 2 0": "mpl-2.0", "epl 2 0": "epl-2.0", "epl 1 0": "epl-1.0",
            "cddl 1 0": "cddl-1.0", "unlicense": "unlicense", "cc0 1 0": "cc0-1.0", "zlib": "zlib",
            "bsl 1 0": "bsl-1.0", "0bsd": "0bsd", "wtfpl": "wtfpl", "ncsa": "ncsa", "ofl 1 1": "ofl-1.1",
            "eupl 1 2": "eupl-1.2", "postgresql": "postgresql", "python 2 0": "python-2.0"}
    for family in ("gpl", "lgpl", "agpl"):
        for v in ("2 0", "2 1", "3 0"):
            for suffix in ("only", "or later"):
                tags[f"{family} {v} {suffix}"] = f"{family}-{v.replace(' ', '.')}-{suffix.replace(' ', '-')}"
    for kind in ("by", "by sa", "by nc", "by nd", "by nc sa", "by nc nd"):
        for v in ("2 0", "2 5", "3 0", "4 0"):
            tags[f"cc {kind} {v}"] = f"cc-{kind.replace(' ', '-')}-{v.replace(' ', '.')}"
    out += [Rule(("spdx license identifier",), f"spdx license identifier {tag}", label, 1.0)
            for tag, label in sorted(tags.items(), key=lambda x: -len(x[0]))]
    # texts of licenses
    out += [
        Rule(("permission is hereby granted free of charge",),
             "permission is hereby granted free of charge to any person obtaining a copy of this software", "mit", 1.0),
        Rule(("permission to use copy modify",), "permission to use copy modify and or distribute this software"
             "(?: \\S+){0,20}? is hereby granted", "isc", 1.0),
        Rule(("redistribution and use in source and binary forms",),
             "redistribution and use in source and binary forms(?: \\S+){0,80}? neither the name", "bsd-3-clause", 1.0),
        Rule(("redistribution and use in source and binary forms",),
             "redistribution and use in source and binary forms with or without modification", "bsd-2-clause", 0.9),
        Rule(("this is free and unencumbered software",), "this is free and unencumbered software released into the public domain",
             "unlicense", 1.0),
        Rule(("do what the fuck you want",), "do what the fuck you want to public license", "wtfpl", 1.0),
        Rule(("everyone is permitted to copy and distribute verbatim copies",),
             "everyone is permitted to copy and distribute verbatim copies of this license document", "gpl", 1.0),
        Rule(("this software is provided as is",), "this software is provided as is without any express or implied warranty",
             "zlib", 0.7),
        Rule(("free software foundation",), "published by the free software foundation", "gpl", 0.8),
    ]
    # Creative Commons: long names and codes, longer kinds first
    kinds = {"attribution noncommercial sharealike": "by-nc-sa", "attribution noncommercial noderivatives": "by-nc-nd",
             "attribution noncommercial noderivs": "by-nc-nd", "attribution sharealike": "by-sa",
             "attribution noncommercial": "by-nc", "attribution noderivatives": "by-nd",
             "attribution noderivs": "by-nd", "attribution": "by"}
    for words, kind in kinds.items():
        out += _versions(f"creative commons {words}(?: international| unported| generic)?(?: licen[sc]e)?",
                         f"cc-{kind}", ("4.0", "3.0"), "creative commons")
    for kind in ("by nc sa", "by nc nd", "by sa", "by nc", "by nd", "by"):
        out += _versions(f"cc {kind}", f"cc-{kind.replace(' ', '-')}", ("4.0", "3.0", "2.0"), f"cc {kind}")
    out += _versions("cc0|creative commons zero", "cc0", ("1.0",), " cc0 ", "creative commons zero")
    # families with versions
    out += _versions("gnu affero general public licen[sc]e|gnu agpl|agpl", "agpl", ("3.0",), " agpl ", "gnu affero")
    out += _versions("gnu (?:lesser|library) general public licen[sc]e|gnu lgpl|lgpl", "lgpl", ("3.0", "2.1", "2.0"),
                     " lgpl ", "gnu lesser general", "gnu library general")
    out += _versions("gnu free documentation licen[sc]e|gfdl", "gfdl", ("1.3", "1.2", "1.1"), " gfdl ", "gnu free documentation")
    out += _versions("gnu general public licen[sc]e|gnu gpl|gpl", "gpl", ("3.0", "2.0", "1.0"), " gpl ", "gnu general public")
    out += _versions("apache (?:software )?licen[sc]e|asl", "apache", ("2.0", "1.1", "1.0"), " asl ", "apache licen",
                     "apache software licen")
    out += _versions("mozilla public licen[sc]e|mpl", "mpl", ("2.0", "1.1", "1.0"), " mpl ", "mozilla public")
    out += _versions("eclipse public licen[sc]e|epl", "epl", ("2.0", "1.0"), " epl ", "eclipse public")
    out += _versions("eclipse distribution licen[sc]e", "edl", ("1.0",), "eclipse distribution")
    out += _versions("common development and distribution licen[sc]e|cddl", "cddl", ("1.1", "1.0"), " cddl ", "common development and")
    out += _versions("european union public licen[sc]e|eupl", "eupl", ("1.2", "1.1"), " eupl ", "european union public")
    out += _versions("sil open font licen[sc]e|open font licen[sc]e", "ofl", ("1.1", "1.0"), "open font")
    out += _versions("boost software licen[sc]e", "bsl", ("1.0",), "boost software")
    out += _versions("academic free licen[sc]e", "afl", ("3.0", "2.1"), "academic free")
    out += _versions("artistic licen[sc]e", "artistic", ("2.0", "1.0"), "artistic licen")
    out += _versions("open software licen[sc]e", "osl", ("3.0", "2.1"), "open software")
    out += _versions("microsoft public licen[sc]e|ms pl", "ms-pl", ("1.0",), " ms pl ", "microsoft public")
    out += _versions("server side public licen[sc]e|sspl", "sspl", ("1.0",), " sspl ", "server side public")
    out += _versions("business source licen[sc]e", "busl", ("1.1",), "business source")
    out += _versions("open database licen[sc]e|odbl", "odbl", ("1.0",), " odbl ", "open database")
    # families without versions
    for name, label, *keywords in (
            ("bsd 3 clause(?: licen[sc]e)?|3 clause bsd(?: licen[sc]e)?|new bsd licen[sc]e|modified bsd licen[sc]e",
             "bsd-3-clause", "bsd 3 clause", "3 clause bsd", "new bsd", "modified bsd"),
            ("bsd 2 clause(?: licen[sc]e)?|2 clause bsd(?: licen[sc]e)?|simplified bsd licen[sc]e|freebsd licen[sc]e",
             "bsd-2-clause", "bsd 2 clause", "2 clause bsd", "simplified bsd", "freebsd licen"),
            ("bsd licen[sc]e", "bsd", "bsd licen"), ("mit licen[sc]e|expat licen[sc]e|x11 licen[sc]e", "mit", "mit licen", "expat licen", "x11 licen"),
            ("isc licen[sc]e", "isc", " isc licen"), ("zlib licen[sc]e|libpng licen[sc]e", "zlib", "zlib licen",
             "libpng licen"),
            ("python software foundation licen[sc]e", "psf", "python software"),
            ("postgresql licen[sc]e", "postgresql", "postgresql"), ("beerware licen[sc]e", "beerware", "beerware"),
            ("ruby licen[sc]e", "ruby", "ruby licen"), ("php licen[sc]e", "php", "php licen"), ("vim licen[sc]e", "vim", "vim licen"),
            ("university of illinois ncsa open source licen[sc]e", "ncsa", "ncsa"),
            ("do not redistribute|redistribution (?:is )?prohibited", "proprietary", "do not redistribute",
             "redistribution is prohibited", "redistribution prohibited"),
            ("released into the public domain|dedicated to the public domain", "public-domain", "the public domain")):
        out += [Rule(tuple(keywords), f"{_GRANT} (?:{name})", label, 1.0), Rule(tuple(keywords), f"(?:{name})", label, 0.8)]
    return out + [Rule(("all rights reserved",), "all rights reserved", "all-rights-reserved", 0.5)]


RULES = _rules()


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.translate(text, UPPER, SMALL), GAP), lambda w: w != "")


def gate(text: Column) -> Column:
    """False only if neither a base phrase nor a rule can match the lower-cased text.

    Every rule's match holds one of these words; the doubtful short ones are
    looked for as words. Words of a phrase may have anything of GAP between them."""
    out = F.lit(False)
    for part in ("licen", "gnu", "spdx", "commons", "cc0", "agpl", "lgpl", "gfdl", "gpl", "cddl", "eupl", "sspl",
                 "odbl", "unencumbered", "redistribut", "bsd"):
        out = out | F.contains(text, F.lit(part))
    for phrase in ("free software", "public domain", "hereby granted", "provided as is"):
        near = F.lit(True)
        for word in phrase.split():
            near = near & F.contains(text, F.lit(word))
        out = out | (near & text.rlike(GAP.join(phrase.split())))
    short = "(^|[^a-z0-9])(cc[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+by|asl|mpl|epl|ms[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+pl|" \
            "all[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+rights)([^a-z0-9]|$)"
    letters = (F.contains(text, F.lit("cc")) | F.contains(text, F.lit("asl")) | F.contains(text, F.lit("mpl"))
               | F.contains(text, F.lit("epl")) | F.contains(text, F.lit("pl")) | F.contains(text, F.lit("rights")))
    return out | (letters & text.rlike(short))


def phrase_starts(words: Column, phrase: str) -> Column:
    """Positions (long) where the phrase's words stand consecutively."""
    first, *rest = phrase.split()
    at = F.filter(F.transform(words, lambda w, i: F.when(w == first, i)), lambda i: i.isNotNull())

    def whole(i: Column) -> Column:
        out = F.lit(True)
        for k, word in enumerate(rest, 1):
            out = out & F.coalesce(F.get(words, i + k) == word, F.lit(False))
        return out

    return F.transform(F.filter(at, whole), lambda i: i.cast("long"))


def detections(joined: Column, rules: list[Rule]) -> Column:
    """array<struct<first, negated last, rule, label, score>> of all matches over ' w1 w2 ... '."""
    table = F.array(*[F.struct(F.lit(i).alias("rule"), F.array(*[F.lit(k) for k in r.keywords]).alias("keywords"),
                               F.lit(f" ((?:{r.pattern}))(?= )").alias("pattern"), F.lit(r.label).alias("label"),
                               F.lit(r.score).alias("score")) for i, r in enumerate(rules)])
    # a match's first word gets a mark in front, its last one behind
    marked = F.transform(F.filter(table, lambda r: F.exists(
        r["keywords"], lambda k: F.contains(joined, k))), lambda r: F.struct(
        r.alias("r"), F.split(F.regexp_replace(joined, r["pattern"], F.lit(" \x01$1\x02")), " ").alias("w")))
    # joined begins with a blank, so word i is part i + 1
    found = F.transform(F.filter(marked, lambda m: F.contains(F.array_join(m["w"], " "), F.lit("\x01"))), lambda m: F.zip_with(
        F.filter(F.transform(m["w"], lambda w, i: F.when(w.startswith("\x01"), i - 1)), lambda i: i.isNotNull()),
        F.filter(F.transform(m["w"], lambda w, i: F.when(w.endswith("\x02"), i - 1)), lambda i: i.isNotNull()),
        lambda s, e: F.struct(s.cast("long").alias("first"), (-e).cast("long").alias("end"),
                              m["r"]["rule"].alias("rule"), m["r"]["label"].alias("label"),
                              m["r"]["score"].alias("score"))))
    return F.array_sort(F.flatten(found))


DETECTION = "struct<first:long,last:long,rule:int,label:string,score:double>"


def accepted(found: Column) -> Column:
    """Suppress contained intervals, and partly overlapping ones of later rules."""
    start = F.struct(F.lit(-1).cast("long").alias("last"), F.lit(-1).alias("rule"),
                     F.array().cast(f"array<{DETECTION}>").alias("kept"))

    def step(a: Column, d: Column) -> Column:
        last = -d["end"]
        drop = (last <= a["last"]) | ((d["first"] <= a["last"]) & (d["rule"] >= a["rule"]))
        kept = F.array_append(a["kept"], F.struct(
            d["first"].alias("first"), last.alias("last"), d["rule"].alias("rule"), d["label"].alias("label"),
            d["score"].alias("score")).cast(DETECTION))
        return F.when(drop, a).otherwise(F.struct(last.alias("last"), d["rule"].alias("rule"), kept.alias("kept")))

    return F.aggregate(found, start, step, lambda a: a["kept"])


def scan(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Per row of docs (doc_id, text; other columns are ignored): doc_id,
    n_words, n_base, first_word, last_word, base_labels, labels, score, and
    detections (first and last word, rule, label, score).

    Words are runs of a-z, 0-9 and non-ASCII characters after A-Z are
    lower-cased. n_base counts every place of a base phrase; first_word and
    last_word are the smallest and largest start (null without any). labels
    holds the base labels and those of accepted detections; score is the
    surest detection's, at least 0.9 with a base phrase, 0 without anything. A
    null text is empty. Each row is scanned by itself, in one pass without a shuffle.
    """
    rules = RULES if rules is None else rules
    t = F.translate(full_text(), UPPER, SMALL)
    base = docs.select("doc_id", words_of(full_text()).alias("_words"), gate(t).alias("_gate"))
    none = F.array().cast("array<long>")
    starts = {label: F.when(F.col("_gate"), phrase_starts(F.col("_words"), phrase)).otherwise(none)
              for phrase, label in BASE.items()}
    joined = F.concat(F.lit(" "), F.array_join("_words", " "), F.lit(" "))
    placed = base.select(
        "doc_id", F.size("_words").cast("long").alias("n_words"),
        *[c.alias(f"_{label}") for label, c in starts.items()],
        F.when(F.col("_gate"), F.transform(F.array(joined), lambda j: accepted(detections(j, rules)))[0])
        .otherwise(F.array().cast(f"array<{DETECTION}>")).alias("detections"))
    # a union of arrays of positions; a phrase's own label where it has any
    places = F.concat(*[F.col(f"_{label}") for label in BASE.values()])
    named = F.filter(F.array(*[F.when(F.size(f"_{label}") > 0, F.lit(label)) for label in BASE.values()]),
                     lambda x: x.isNotNull())
    out = placed.select("doc_id", "n_words", "detections", places.alias("_places"), named.alias("_labels"))
    surest = F.coalesce(F.array_max("detections.score"), F.lit(0.0))
    return out.select(
        "doc_id", "n_words", F.size("_places").cast("long").alias("n_base"),
        F.array_min("_places").alias("first_word"), F.array_max("_places").alias("last_word"),
        F.array_join(F.array_sort("_labels"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("_labels", "detections.label")), ",").alias("labels"),
        F.when(F.size("_places") > 0, F.greatest(F.lit(0.9), surest)).otherwise(surest).alias("score"),
        "detections")
