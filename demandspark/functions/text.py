"""Word processing of product names as array expressions (no Python UDF).

lower -> split on whitespace -> drop Spanish stop words -> strip one suffix ->
join with blanks. The stop words equal Spark ML's Spanish list; they are stated
here, so importing the package reads no jar and the same list serves the Spark
job and the SQL oracle.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of Spanish stemming: letters, then the suffixes of each step.
_V, _C = "[aeiouáéíóúü]", "[^aeiouáéíóúü]"
RV_HEAD = f"^(.{_C}+{_V}|{_V}{_V}+{_C}|{_C}{_V}.)"      # what stands before the region RV
R1_HEAD = f"^({_C}*{_V}+{_C})"                           # ... R1: after a vowel and a consonant
R2_HEAD = f"^({_C}*{_V}+{_C}+{_V}+{_C})"                 # ... R2: the same once more
PRONOUNS = "me|se|sel[ao]s?|l[aeo]s?|nos"
GERUNDS = "iéndo|ándo|[áéí]r|iendo|ando|[aei]r|yendo"     # an attached pronoun follows one of these
NOUN = "anzas?|ic[oa]s?|ismos?|[ai]bles?|istas?|os[oa]s?|[ai]mientos?"
AGENT = "ador(?:a|as|es)?|ación|aciones|antes?|ancias?"
OTHER_NOUN = "logías?|ución|uciones|encias?|amente|mente|idad|idades|iv[ao]s?"
Y_VERB = "yeron|yendo|yamos|yais|yan|yen|yas|yes|ya|ye|yo|yó"
PLAIN_VERB = "en|es|éis|emos"
VERB = ("[aei]r(?:ían|ías|íais|íamos|ía|án|ás|á|éis|é|emos)|[ai]das?|[ai]dos?|ían|ías|íais|íamos|ía|"
        "abas?|aban|abais|ábamos|aras?|aran|arais|áramos|ieras?|ieran|ierais|iéramos|"
        "ases?|asen|aseis|ásemos|ieses?|iesen|ieseis|iésemos|[ai]ste|[ai]steis|aron|ieron|ando|iendo|"
        "ió|[aei]r|[aei]d|amos|imos|an|as|ís|áis")


def stem_steps() -> list[dict[str, str]]:
    """The steps of Spanish stemming by word regions, in order. Each maps the
    fields of a struct ``x`` to the next struct's, as SQL expressions; the first
    one takes the word itself, the last one leaves it in field ``w``.

    A suffix goes only if it lies in the step's region (RV, R1 or R2, fixed by
    the first vowel groups); of several suffixes the longest counts."""
    def region(head: str) -> str:
        found = f"length(regexp_extract(x, '{head}', 1))"
        return f"CASE WHEN {found} = 0 THEN length(x) ELSE {found} END"

    def last(field: str, pattern: str) -> str:
        return f"regexp_extract({field}, '({pattern})$', 1)"

    keep = {"rv": "x.rv", "r1": "x.r1", "r2": "x.r2"}
    tail = "substr(x.w, x.rv + 1)"
    head = "left(x.w, length(x.w) - length(x.s))"       # the word without the suffix found
    at = "length(x.w) - length(x.s)"
    form = "length(x.w) - length(x.p) - length(x.m)"

    def held(pattern: str) -> str:   # the suffix found is one of these
        return f"regexp_extract(x.s, '^({pattern})$', 1) <> ''"

    # what may stand in front of a suffix that went, and goes with it if in R2
    before = (f"CASE WHEN NOT x.cut THEN '' WHEN {held(AGENT)} THEN {last('x.w', 'ic')} "
              f"WHEN x.s = 'amente' AND length(x.w) - 4 >= x.r2 THEN {last('x.w', 'ativ|iv|os|ic|ad')} "
              f"WHEN x.s = 'amente' THEN {last('x.w', 'iv|os|ic|ad')} "
              f"WHEN x.s = 'mente' THEN {last('x.w', 'ante|able|ible')} "
              f"WHEN {held('idad|idades')} THEN {last('x.w', 'abil|ic|iv')} "
              f"WHEN {held('iv[ao]s?')} THEN {last('x.w', 'at')} ELSE '' END")
    return [
        {"w": "x", "rv": region(RV_HEAD), "r1": region(R1_HEAD), "r2": region(R2_HEAD)},
        # attached pronouns
        {"w": "x.w", **keep, "m": f"regexp_extract({tail}, '({GERUNDS})(?:{PRONOUNS})$', 1)",
         "p": f"regexp_extract({tail}, '(?:{GERUNDS})({PRONOUNS})$', 1)"},
        {"w": f"CASE WHEN x.m = '' OR (x.m = 'yendo' AND substr(x.w, {form}, 1) <> 'u') THEN x.w "
              f"ELSE concat(left(x.w, {form}), translate(x.m, 'áéí', 'aei')) END", **keep},
        # nouns, adverbs and adjectives
        {"w": "x.w", **keep, "s": last("x.w", f"{NOUN}|{AGENT}|{OTHER_NOUN}")},
        {"w": f"CASE WHEN x.s = '' OR {at} < CASE WHEN x.s = 'amente' THEN x.r1 ELSE x.r2 END THEN x.w "
              f"WHEN {held('logías?')} THEN concat({head}, 'log') WHEN {held('ución|uciones')} THEN concat({head}, 'u') "
              f"WHEN {held('encias?')} THEN concat({head}, 'ente') ELSE {head} END", **keep, "s": "x.s",
         "cut": f"x.s <> '' AND {at} >= CASE WHEN x.s = 'amente' THEN x.r1 ELSE x.r2 END"},
        {"w": "x.w", **keep, "cut": "x.cut", "s": before},
        {"w": f"CASE WHEN x.s <> '' AND {at} >= x.r2 THEN {head} ELSE x.w END", **keep, "cut": "x.cut"},
        # verbs, if no noun's suffix went: those with y after u, then the others
        {"w": "x.w", **keep, "cut": "x.cut", "s": f"CASE WHEN x.cut THEN '' ELSE {last(tail, Y_VERB)} END"},
        {"w": f"CASE WHEN x.s <> '' AND substr(x.w, {at}, 1) = 'u' THEN {head} ELSE x.w END", **keep,
         "cut": f"x.cut OR (x.s <> '' AND substr(x.w, {at}, 1) = 'u')"},
        {"w": "x.w", **keep, "s": f"CASE WHEN x.cut THEN '' ELSE {last(tail, f'{VERB}|{PLAIN_VERB}')} END"},
        {"w": f"CASE WHEN {held(PLAIN_VERB)} AND substr(x.w, {at} - 1, 2) = 'gu' "
              f"THEN left(x.w, {at} - 1) ELSE {head} END", **keep},
        # what is left of an ending
        {"w": "x.w", **keep, "s": last(tail, "os|[aoáíóeé]")},
        {"w": f"CASE WHEN {held('[eé]')} AND substr(x.w, {at} - 1, 2) = 'gu' AND {at} - 1 >= x.rv "
              f"THEN left(x.w, {at} - 1) ELSE {head} END"},
        {"w": "translate(x.w, 'áéíóú', 'aeiou')"},
    ]


TOKEN_PATTERN = r"\b\w\w+\b"   # word tokens of two or more word characters


# Spanish stop words that are not verb forms built by a rule below.
STOP_WORDS = """
de la que el en y a los del se las por un para con no una su al lo como más pero sus le ya o este
sí porque esta entre cuando muy sin sobre también me hasta hay donde quien desde todo nos durante
todos uno les ni contra otros ese eso ante ellos e esto mí antes algunos qué unos yo otro otras
otra él tanto esa estos mucho quienes nada muchos cual poco ella estar estas algunas algo nosotros
mi mis tú te ti tu tus ellas nosotras vosostros vosostras os nuestro nuestra nuestros nuestras
vuestro vuestra vuestros vuestras esos esas estoy estás está estamos estáis están esté estés
estemos estéis estén estad he has ha hemos habéis han soy eres es somos sois son era eras éramos
erais eran fui fuiste fue fuimos fuisteis fueron siente sentid tengo tienes tiene tenemos tenéis
tienen tened
""".split()

# Endings by tense; stems of ser, estar, haber, tener that take them.
_FUTURE = ["é", "ás", "á", "emos", "éis", "án"]
_IMPERFECT = ["ía", "ías", "íamos", "íais", "ían"]
_PRESENT_SUBJUNCTIVE = ["a", "as", "amos", "áis", "an"]
_PRETERITE = ["e", "iste", "o", "imos", "isteis", "ieron"]
_AGREEMENT = ["o", "a", "os", "as"]


def _past_subjunctive(third_person: str) -> list[str]:
    """Forms in -ra and -se from the stem before -ron (estuvie-, fue-...)."""
    accented = third_person[:-1] + "é"
    return [(accented if end.endswith("mos") else third_person) + end
            for t in ("ra", "se")
            for end in (t, t + "s", t + "mos", t + "is", t + "n")]


def _verb_forms() -> list[str]:
    out = []
    for stem_ in ("estar", "habr", "ser", "tendr"):
        out += [stem_ + e for e in _FUTURE + _IMPERFECT]
    out += ["estab" + e for e in ("a", "as", "ais", "an")] + ["estábamos"]
    out += [stem_ + e for stem_ in ("hab", "ten") for e in _IMPERFECT]
    out += [stem_ + e for stem_ in ("hay", "se", "teng") for e in _PRESENT_SUBJUNCTIVE]
    out += [stem_ + e for stem_ in ("estuv", "hub", "tuv") for e in _PRETERITE]
    for third in ("estuvie", "hubie", "fue", "tuvie"):
        out += _past_subjunctive(third)
    out += ["estando", "habiendo", "sintiendo", "teniendo"]
    out += [stem_ + e for stem_ in ("estad", "habid", "sentid", "tenid", "mí", "tuy", "suy")
            for e in _AGREEMENT]
    return out


@functools.lru_cache(maxsize=None)
def spanish_stop_words() -> tuple[str, ...]:
    """The 313 words of Spark ML's Spanish list: fixed words plus verb forms by rule."""
    return tuple(dict.fromkeys(STOP_WORDS + _verb_forms()))


def stemmed(kept: Column) -> Column:
    """The stems of an array column of lower-case words, in its order. One pass
    over the array per step, so that no step's result is computed twice."""
    out = "x"
    for fields in stem_steps():
        packed = ", ".join(f"'{k}', {v}" for k, v in fields.items())
        out = f"transform({out}, x -> named_struct({packed}))"
    return F.call_function("transform", F.array(kept), F.expr(f"x -> transform({out}, x -> x.w)"))[0]


def words(text: str | Column) -> Column:
    t = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.trim(F.lower(t)), r"\s+"), lambda w: F.length(w) > 0)


def processed_name(text: str) -> Column:
    """Stop words of the named column removed (a hash lookup per word), each word
    stemmed, re-joined with single blanks."""
    kept = F.filter(words(text), lambda w: ~w.isin(*spanish_stop_words()))
    return F.array_join(stemmed(kept), " ")


def tokens(text: str | Column) -> Column:
    """Tokens of two or more word characters (the bag-of-words tokenizer)."""
    t = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(t), F.lit(r"(\w\w+)"), 1)


def drop_stop_words(df, tokens_col: str, out_col: str):
    """Remove Spanish stop words from an array column with Spark ML's
    StopWordsRemover (hash-set lookup per token in the JVM; order and
    repeated words are kept)."""
    from pyspark.ml.feature import StopWordsRemover
    return StopWordsRemover(inputCol=tokens_col, outputCol=out_col,
                            stopWords=list(spanish_stop_words()), caseSensitive=True).transform(df)
