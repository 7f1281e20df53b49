"""Line-first quality rules, as DataFrame functions only.

Each line is held against punctuation, navigation and boilerplate rules in
English, German, French and Spanish, and against rules on how it ends; failing
lines are removed, and a document that loses too much of its text is rejected,
as is one that is too short or repeats itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.llm.common import full_text

MIN_WORDS = 50
MAX_REPEATED = 50        # percent of words in repeated 3-word windows
MAX_LOST = 50            # percent of word characters in removed lines
MAX_LINE_SYMBOLS = 10    # percent of a line's word characters that are symbols
MAX_LINE_SHOUTS = 10     # percent of a line's word characters that are exclamation marks
MIN_OPEN_WORDS = 4       # words of a line that doesn't end like a sentence, at least

# White space between words and the symbols counted.
WHITE = " \t\n\x0b\x0c\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
# Words of site navigation, alone at the start of a line or of a
# cell ("Home | Menu"), by language (English, German, French, Spanish).
NAVIGATION_WORDS = (
    "home", "menu", "login", "log in", "log out", "logout", "sign in", "sign up", "sign out", "register", "next",
    "previous", "search", "share", "site map", "sitemap", "contact us", "about us", "skip to content", "back to top",
    "startseite", "menü", "anmelden", "abmelden", "registrieren", "weiter", "zurück", "suche", "suchen", "teilen",
    "kontakt", "impressum", "über uns", "nach oben", "zum inhalt springen",
    "accueil", "connexion", "se connecter", "déconnexion", "inscription", "suivant", "précédent", "rechercher",
    "partager", "plan du site", "nous contacter", "à propos", "haut de page", "aller au contenu",
    "inicio", "menú", "iniciar sesión", "cerrar sesión", "registrarse", "siguiente", "anterior", "buscar",
    "compartir", "mapa del sitio", "contacto", "sobre nosotros", "volver arriba", "saltar al contenido")
# Phrases of legal notices, consent banners, teasers and templates, by language.
BOILERPLATE_PHRASES = (
    "all rights reserved", "terms of use", "terms of service", "terms and conditions", "privacy policy",
    "cookie policy", "uses cookies", "accept cookies", "accept all cookies", "enable javascript", "lorem ipsum",
    "click here", "read more", "learn more", "subscribe to our", "sign up for our newsletter", "powered by",
    "follow us on", "share this article", "leave a comment", "page not found", "your browser does not support",
    "alle rechte vorbehalten", "nutzungsbedingungen", "allgemeine geschäftsbedingungen", "datenschutzerklärung",
    "verwendet cookies", "cookies akzeptieren", "javascript aktivieren", "hier klicken", "klicken sie hier",
    "weiterlesen", "mehr erfahren", "newsletter abonnieren", "folgen sie uns", "artikel teilen",
    "kommentar hinterlassen", "seite nicht gefunden",
    "tous droits réservés", "conditions d'utilisation", "conditions générales", "mentions légales",
    "politique de confidentialité", "utilise des cookies", "accepter les cookies", "activer javascript",
    "cliquez ici", "lire la suite", "en savoir plus", "abonnez-vous à notre", "suivez-nous sur",
    "partager cet article", "laisser un commentaire", "page introuvable",
    "todos los derechos reservados", "condiciones de uso", "términos y condiciones", "aviso legal",
    "política de privacidad", "política de cookies", "utiliza cookies", "aceptar cookies", "activar javascript",
    "haga clic aquí", "haz clic aquí", "leer más", "saber más", "suscríbete a nuestro", "síguenos en",
    "compartir este artículo", "deja un comentario", "página no encontrada")


def _any_case(phrase: str) -> str:
    """A pattern for the phrase under (?i), which folds ASCII letters only: others in both cases."""
    return "".join(c if c.isascii() else f"[{c}{c.upper()}]" for c in phrase)


#: Line rules: a line that contains a match is removed.
NAVIGATION = (f"(?i)(^|{SPACE_RUN})({'|'.join(map(_any_case, NAVIGATION_WORDS))})"
              "[\\x20\\x09-\\x0D]*([|>»/·]|$)")
BOILERPLATE = f"(?i)({'|'.join(map(_any_case, BOILERPLATE_PHRASES))})"
#: A line that is a web address and nothing else.
ADDRESS = "(?i)^[\\x20\\x09-\\x0D]*(https?://|www[.])[^\\x20\\x09-\\x0D]+[\\x20\\x09-\\x0D]*$"
#: Each match of these rules holds one of these parts in small letters: common stems, and
#: the phrases without any; phrases that hold another are left out.
STEMS = ("cookie", "javascript", "newsletter", "http", "www")
_PARTS = {*STEMS, *(p for p in NAVIGATION_WORDS + BOILERPLATE_PHRASES if not any(x in p for x in STEMS))}
KEYWORDS = tuple(sorted(p for p in _PARTS if not any(q != p and q in p for q in _PARTS)))
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ" + "".join(sorted({c.upper() for p in KEYWORDS for c in p if not c.isascii()}))
# Fixed value: characters at which a line may end whatever its length.
ENDS = ".!?:;,…\"'”’»)]"


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def count_of(text: Column, characters: str) -> Column:
    """How many code points of ``text`` are among ``characters``."""
    return F.char_length(text) - F.char_length(without(text, characters))


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE_RUN), lambda w: w != "")


def has_symbols(line: Column) -> Column:
    """Punctuation rules of one line."""
    size = F.char_length(without(line, WHITE))
    return ((count_of(line, SYMBOLS) * 100 > size * MAX_LINE_SYMBOLS)
            | (count_of(line, "!") * 100 > size * MAX_LINE_SHOUTS))


def has_phrase(line: Column) -> Column:
    """Navigation and boilerplate rules of one line."""
    return line.rlike(NAVIGATION) | line.rlike(BOILERPLATE) | line.rlike(ADDRESS)


def ends_badly(line: Column) -> Column:
    """A line that breaks off, or a few words without the end of a sentence; lines without words pass."""
    whole = F.rtrim(line, F.lit(WHITE))
    last = F.right(whole, F.lit(1))
    teaser = (last == "…") | F.endswith(whole, F.lit("..."))
    return (last != "") & (teaser | (~F.contains(F.lit(ENDS), last) & (F.size(words_of(line)) < MIN_OPEN_WORDS)))


def has_any(text: Column, parts) -> Column:
    out = F.lit(False)
    for part in parts:
        out = out | F.contains(text, F.lit(part))
    return out


def may_hold_phrase(text: Column) -> Column:
    """False only if no line of ``text`` is in ``has_phrase``: substring tests, far cheaper than the rules."""
    return has_any(F.translate(text, UPPER, UPPER.lower()), KEYWORDS)


def repeated_words(words: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more in the text.

    The windows' hashes are sorted with their positions, so equal windows are
    neighbours; n log n for a text of n words."""
    return F.transform(F.array(words), _repeated)[0]   # bound once: each window reads it


def _repeated(words: Column) -> Column:
    n = F.size(words)
    windows = F.transform(F.sequence(F.lit(0), n - 3),
                          lambda i: F.struct(F.xxhash64(F.get(words, i), F.get(words, i + 1),
                                                        F.get(words, i + 2)).alias("h"), i.alias("p")))

    def covered(ranked: Column) -> Column:
        def same(k: Column, j: Column) -> Column:
            return F.coalesce(F.get(ranked, k)["h"] == F.get(ranked, j)["h"], F.lit(False))

        # positions in rank order, back in text order
        hits = F.array_sort(F.filter(
            F.transform(ranked, lambda x, k: F.when(same(k, k - 1) | same(k, k + 1), x["p"])),
            lambda p: p.isNotNull()))
        # a window adds the words up to the next repeated window, three at most
        return F.aggregate(hits, F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-3).alias("at")),
                           lambda a, p: F.struct((a["sum"] + F.least(F.lit(3), p - a["at"])).alias("sum"),
                                                 p.alias("at")),
                           lambda a: a["sum"])

    return F.when(n < 4, F.lit(0).cast("long")).otherwise(
        F.transform(F.array(F.sort_array(windows)), covered)[0])


def clean_documents(docs: DataFrame) -> DataFrame:
    """Per row of docs (doc_id, text; other columns are ignored): doc_id, text
    (the lines that pass, in order; null stays null), n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words, n_lines_removed, base_failed, kept.

    Words are split at ASCII white space, lines at line feeds; a null or empty
    text has none, fails as too short and isn't kept. base_failed: fewer than
    50 words, or more than half of the words in repeated 3-word windows. kept:
    not base_failed, and at most half of the word characters are in removed
    lines. A line is removed if it holds too many symbols or exclamation marks,
    navigation or boilerplate, or nothing but a web address, if it breaks off
    ("..."), or if it is short and doesn't end like a sentence; a line without
    words stays. Extra columns may have any names; an empty table gives no rows.
    Each row is judged by itself, so repeated rows are judged alike.
    """
    t = full_text()
    base = docs.select("doc_id", "text", t.alias("_t"), words_of(t).alias("_words"),
                       F.split(t, "\n").alias("_lines"), may_hold_phrase(t).alias("_phrases"),
                       has_any(t, "!" + SYMBOLS).alias("_symbols"))
    measured = base.select(
        "doc_id", "text", "_lines", "_phrases", "_symbols", F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.when(has_any(F.col("_t"), SYMBOLS), count_of(F.col("_t"), SYMBOLS)).otherwise(0).cast("long")
        .alias("n_symbols"),
        F.filter("_lines", lambda x: without(x, WHITE) != "").alias("_full"),
        repeated_words(F.col("_words")).alias("n_repeat_words"))
    judged = measured.select(
        "*", (F.size("_full") - F.size(F.array_distinct("_full"))).cast("long").alias("n_dup_lines"),
        F.filter("_lines", lambda x: ~(ends_badly(x) | (F.col("_symbols") & has_symbols(x))
                                       | (F.col("_phrases") & has_phrase(x)))).alias("_passed"))
    cut = F.size("_passed") < F.size("_lines")
    cleaned = judged.select(
        "*", F.when(cut, F.array_join("_passed", "\n")).otherwise(F.col("text")).alias("_clean"),
        cut.alias("_cut"), ((F.col("n_words") < MIN_WORDS)
                            | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED)).alias("base_failed"))
    left = F.when(F.col("_cut"), F.char_length(without(F.col("_clean"), WHITE))).otherwise(F.col("word_chars"))
    return cleaned.select(
        "doc_id", F.col("_clean").alias("text"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", (F.size("_lines") - F.size("_passed")).cast("long").alias("n_lines_removed"),
        "base_failed",
        (~F.col("base_failed")
         & ((F.col("word_chars") - left) * 100 <= F.col("word_chars") * MAX_LOST)).alias("kept"))
