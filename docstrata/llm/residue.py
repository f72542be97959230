"""Template residue, filler and error-page text (problem 2).

One Aho-Corasick automaton holds multilingual phrases of error pages, refusals, filler and
script notices, the parts (notices.py) that such sentences are put together from in any language, and
the openings of placeholders. It passes each text once; what it meets is
weighed against the sentence it stands in: the text is excluded when matched phrases cover at
least COVERAGE of a sentence, or parts at least PARTS_COVERAGE of one that says what failed, asks for
scripts, cookies or a sign-in, or asks for a text to be filled in. Words inside quotation marks are what a
picture shows, and a sentence that merely names an error has low coverage, so descriptions of
such things stay. A placeholder is never prose: where the automaton meets an opening, its syntax
is confirmed in place, and any confirmed one excludes the text.

Results: null, empty and blank texts are no residue. Rows with a null id are left out.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docstrata.llm import notices

COVERAGE = 0.55
PARTS_COVERAGE = 0.8

#: Phrases of errors and refusals, lower case; '#' stands for a number.
ERRORS = (
    "access denied", "permission denied", "request denied", "forbidden", "unauthorized", "not authorized", "reference #", "ticket #", "request id #",
    "internal server error", "server error", "bad gateway", "gateway timeout", "gateway time-out", "service unavailable", "the service is unavailable", "service temporarily unavailable", "nginx", "apache", "cloudflare",
    "page not found", "not found", "file not found", "image not found", "# not found", "the page you", "the page you requested", "the page you are looking for", "does not exist", "no longer exists", "could not be found", "was not found", "has moved", "is not available", "is no longer available", "oops", "error #", "http error", "http error #", "http #", "status #", "code #",
    "something went wrong", "something went wrong on our side", "an error occurred", "an error has occurred", "unexpected error", "sorry", "please reload the page", "reload the page", "please try again later", "please try again", "try again later", "try again", "retry later", "retry in # seconds", "in # seconds", "and reload",
    "too many requests", "too many requests from", "from your network", "slow down", "rate limit exceeded", "quota exceeded", "request failed", "connection refused", "connection reset", "connection timed out", "read timed out", "timed out", "timeout", "connectionerror", "timeouterror", "traceback", "most recent call last", "exception",
    "this site can't be reached", "this site cannot be reached", "check the connection", "check the connection and try again", "server answered #", "server answered",
    "image failed to load", "failed to load", "failed to load image", "error loading figure data", "error loading", "loading", "please wait", "caption unavailable", "no candidates returned", "empty response", "unavailable", "\"error\"", "no caption available", "image unavailable", "image not available", "not available", "could not be loaded", "could not load",
    "session expired", "sign in again", "sign in", "log in", "please log in", "to view this figure", "to see this figure", "subscribe to continue",
    "i cannot describe", "i can't describe", "i cannot help with", "i can't help with", "i'm sorry", "i am sorry", "i'm unable to", "i am unable to", "unable to describe", "cannot assist", "can't assist", "as an ai language model", "as a language model", "as an ai", "this image", "with that request", "i cannot", "i can't", "unable to",
    "verify that you are not a robot", "verify you are human", "not a robot", "to see the picture", "checking your browser", "checking your browser before", "before opening the figure", "captcha",
    "seite nicht gefunden", "nicht gefunden", "fehler", "fehler #", "zugriff verweigert", "bitte warten", "ein fehler ist aufgetreten", "interner serverfehler", "bitte versuchen sie es später erneut",
    "page introuvable", "page non trouvée", "erreur", "erreur #", "accès refusé", "veuillez patienter", "une erreur est survenue", "erreur interne du serveur", "veuillez réessayer plus tard", "réessayez plus tard", "désolé",
    "página no encontrada", "no se encontró la página", "no encontrada", "error #", "acceso denegado", "espere por favor", "ha ocurrido un error", "se ha producido un error", "error interno del servidor", "inténtelo de nuevo más tarde", "lo sentimos",
    "pagina non trovata", "accesso negato", "si è verificato un errore", "pagina niet gevonden", "toegang geweigerd",
)
#: Notices about scripts, cookies and the browser.
SCRIPTS = (
    "enable javascript", "please enable javascript", "javascript is required", "javascript is required to display", "display this figure", "display the figure", "display this image", "javascript is disabled", "requires javascript", "turn on javascript", "you need to turn on", "javascript", "java script", "noscript", "scripts are blocked", "because scripts are blocked", "scripting support is needed", "scripting support", "to zoom", "to load the full image", "to view the image", "to see the image", "to view this image", "in your browser",
    "image viewer could not start", "this viewer does not work without js", "does not work without", "switch it on", "without js",
    "enable cookies", "enable cookies and scripts", "we use cookies", "this site uses cookies", "accept all", "accept cookies", "accept all to show this figure", "to show this figure", "cookies", "cookie settings",
    "your browser is out of date", "your browser is not supported", "update your browser", "unsupported browser", "browser not supported",
    "bitte aktivieren sie javascript", "aktivieren sie", "um das bild zu sehen", "wir verwenden cookies", "ihr browser wird nicht unterstützt", "ihr browser ist veraltet",
    "veuillez activer javascript", "activer javascript", "pour voir l'image", "pour voir l’image", "nous utilisons des cookies", "votre navigateur n'est pas pris en charge", "votre navigateur",
    "active javascript", "habilite javascript", "por favor active javascript", "para ver la imagen", "usamos cookies", "utilizamos cookies", "su navegador no es compatible", "su navegador",
)
#: Filler and unfilled descriptions.
FILLER = (
    "your caption here", "caption goes here", "caption here", "your text here", "text goes here", "caption text to be added", "to be added", "add caption", "add a caption", "enter a description", "enter a description of this image", "enter a description of", "enter caption", "insert caption", "insert caption here", "insert description here", "insert text here", "description here", "image description here", "todo", "todo: write caption", "write caption", "tbd by author", "by author", "to be determined", "to be defined", "fill in", "fill in later", "n/a - fill in", "caption placeholder", "replace before release", "placeholder text", "placeholder", "replace me", "untitled figure", "untitled image", "untitled", "sample text", "dummy text", "lorem ipsum", "lorem ipsum dolor sit amet", "no description", "no caption", "missing caption", "x.x", "figure x.x", "title",
    "beschreibung hier einfügen", "hier einfügen", "bildunterschrift hier", "text hier einfügen", "platzhalter", "beispieltext", "insérer la description ici", "insérer une légende", "légende à compléter", "à compléter", "texte à insérer", "insertar descripción aquí", "descripción aquí", "añadir leyenda", "pendiente de completar", "texto de ejemplo", "inserire qui la descrizione",
)
#: Whole texts that stand for a missing value.
EMPTY_VALUES = frozenset("none null undefined nan nil n/a na tbd todo tba xxx xxxx test asdf placeholder untitled - -- ? ... … caption description title image figure".split()) | {"[object object]", "object object", "no data", "to do"}
#: Latin of printers' filler.
LATIN = frozenset(
    "lorem ipsum dolor sit amet consectetur adipiscing adipisicing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum".split()
)
#: Markup elements that may stand in a text without being a placeholder.
MARKUP = frozenset("a abbr b big blockquote body br center code dd div dl dt em font h1 h2 h3 h4 h5 h6 head hr html i img li link meta noscript ol p pre q s script small span strike strong style sub sup table tbody td th thead tr tt u ul var video".split())
#: Function words allowed beside phrases without lowering their coverage.
GLUE = frozenset("the a an to of for in on at is are was and or this that it you your our we please be been with from by before again der die das und zu um ist sie bitte le la les et pour de du est el los y para por se un una # - – — must be has does no not os as ao aos do da dos das um uma ce cet cette des aux dans au sur avec del al lo los las con para su sus en il gli di della nel nei een het om door op van met voor in zum zur im am den dem ein eine eines des mit für och att är det ett i w na z jest się do o и в на с не был была было от bir ve".split())

#: Placeholder syntax of any length; tried only where the automaton met its opening. What stands between the
#: marks excludes them, so a match is over at the next one.
SYNTAX = {
    "{": re.compile(r"\{\{[^{}]+\}\}|\{%[^%{}]+%\}|\{[A-Za-z_][\w.]+\}|(?<![\w^})$])\{\d{0,2}\}(?![\w$])"),
    "$": re.compile(r"\$\{[^{}]+\}|\$\([A-Za-z_][\w.]*\)|(?<![\w$])\$(?i:caption|title|description|legend|alt_?text|image_?text|fig(?:ure)?_?(?:caption|title))\b(?!\$)"),
    "<": re.compile(r"<%=?[^%<>]+%>|<<[A-Za-z_][\w .-]*>>|<([A-Za-z_][\w.-]*)>|<no [a-z]+>", re.IGNORECASE),
    "[": re.compile(r"\[\[[^\[\]]+\]\]|\[\s*insert\b[^\[\]]*\]|\[[^\[\]]+\bgoes here\s*\]|\[(?:your|add|enter)\b[^\[\]]+\]|\[[A-Z]+(?:[_ ][A-Z]+)*\](?!\()", re.IGNORECASE),
    "%": re.compile(r"%%[A-Za-z_][\w.]*%%|%\([A-Za-z_]\w*\)[sdf]|(?<![\w%.,])%[sd](?!\w)|(?<![\w%])%[A-Z][A-Z_]{2,}%"),
    "#": re.compile(r"#[A-Za-z_][\w.]*#|#\{[^{}]+\}"),
    "_": re.compile(r"__[A-Za-z][A-Za-z0-9_.]*?__"),
    "@": re.compile(r"@@[A-Za-z_][\w.]*@@"),
}
#: A whole text that is the name of a variable.
NAMED = re.compile(r"[$@:%&][a-z_][\w.-]{2,}[%:;]?")
QUOTED = re.compile(r"“[^”]*”|„[^“”]*[“”]|«[^»]*»|‘[^’]*’")
SENTENCE = re.compile(r"(?<=[.!?…])[\s\"')\]]+|[\[\]()\n|]+|(?<=\.)$")
WORD = re.compile(r"[^\W_]+(?:['’./-][^\W_]+)*|#")
PREFIX = re.compile(r"^\s*(?:[*\"'>•-]+\s*)*(?:(?:figure|fig\.?|abb\.?|abbildung|figura|image)\s*#?\d+\s*[:.]\s*)?", re.IGNORECASE)
TAG = re.compile(r"</?(?:%s)\b[^<>]*>" % "|".join(sorted(MARKUP | {"title"})), re.IGNORECASE)


#: Kinds of parts, as bits: a whole phrase, what failed, what to do, techniques, subjects, verbs and objects of filler.
PHRASE, FAILURE, REQUEST, TECHNIQUE, SUBJECT, VERB, OBJECT, PRINTERS = (1 << k for k in range(8))
#: Without one of these in it a sentence is no residue.
DECISIVE = PHRASE | FAILURE | REQUEST | VERB | PRINTERS
#: Scripts written without blanks, where parts need no ends of words.
CLOSE = re.compile(r"[\u0e00-\u0eff\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af]")


@cache
def automaton():
    import ahocorasick

    kinds: dict[str, int] = {phrase: PHRASE for phrase in {*ERRORS, *SCRIPTS, *FILLER}}
    for bit, table in ((FAILURE, notices.FAILURES), (REQUEST, notices.REQUESTS), (TECHNIQUE, notices.TECHNIQUES), (SUBJECT, notices.SUBJECTS), (VERB, notices.FILLER_VERBS), (OBJECT, notices.FILLER_OBJECTS)):
        for part in notices.parts(table):
            if part not in GLUE:
                kinds[part] = kinds.get(part, 0) | bit
    for word in LATIN - GLUE:
        kinds[word] = kinds.get(word, 0) | PRINTERS
    a = ahocorasick.Automaton()
    for part, bits in kinds.items():
        a.add_word(part.rstrip("*"), (part.rstrip("*"), bits, part.endswith("*")))
    for opening in SYNTAX:
        a.add_word(opening, (opening, 0, True))
    a.make_automaton()
    return a


def is_notice(bits: list[int], weight: list[int]) -> bool:
    """Whether the parts of a sentence (their kinds, and 0 for words that are none) make a notice or a request for a text."""
    parts = bits
    total = sum(weight)
    if sum(w for b, w in zip(parts, weight) if b) < PARTS_COVERAGE * total:
        return False
    if sum(b > 0 for b in parts) < 2:  # one part that is a sentence by itself
        return any(b & FAILURE and w >= 2 for b, w in zip(parts, weight))
    has = lambda kind: any(b & kind for b in parts)
    others = lambda kind: sum(bool(b) and not b & ~kind == 0 for b in parts)
    if has(FAILURE) and others(FAILURE) or has(REQUEST) and has(TECHNIQUE):
        return True
    return has(VERB) and any(b & OBJECT and not b & VERB for b in parts) and sum(w for b, w in zip(parts, weight) if b & (VERB | OBJECT)) >= PARTS_COVERAGE * total


def is_residue(caption: str | None) -> bool:
    if caption is None or not caption.strip():
        return False
    text = html.unescape(html.unescape(caption)) if "&" in caption else caption
    text = TAG.sub(" ", text)
    masked = QUOTED.sub(lambda m: " " * len(m[0]), text)
    body = PREFIX.sub("", masked).strip(" \t\r\n*\"'")
    low = re.sub(r"[\d][\d.,]*\d|\d", "#", body.lower().replace("’", "'"))
    covered, decisive = bytearray(len(low)), 0
    found: list[tuple[int, int, int]] = []
    for end, (what, bits, free) in automaton().iter(low):
        first = end - len(what) + 1
        if bits:
            before, after = low[first - 1 : first] if first else "", low[end + 1 : end + 2]
            joined = [x.isalnum() and not CLOSE.match(x) for x in (before or " ", after or " ")]
            if CLOSE.match(what) or not (what[0].isalnum() and joined[0]) and (free or not (what[-1].isalnum() and joined[1])):
                if bits & PHRASE:
                    covered[first : end + 1] = b"\1" * len(what)
                decisive |= bits & DECISIVE
                if bits & ~(PHRASE | PRINTERS):
                    found.append((first, end + 1, bits & ~(PHRASE | PRINTERS)))
    if any(c in masked for c in SYNTAX):
        for what in {what for _, (what, bits, _) in automaton().iter(masked) if not bits}:
            if any((m[0][0] != "<" or not m.groups() or not m[1] or m[1].lower() not in MARKUP) for m in SYNTAX[what].finditer(masked)):
                return True
    plain = re.sub(r"\s+", " ", low).strip(" .:;,!?")
    if plain in EMPTY_VALUES or NAMED.fullmatch(plain):
        return True
    tokens = WORD.findall(plain)
    if not tokens:
        return False
    if len(tokens) > 1 and len(set(tokens)) == 1 and (tokens[0] in EMPTY_VALUES or set(tokens[0]) == {"x"}):
        return True
    if plain[:1] in "{[" and covered.count(1) >= 4:  # a bare answer of a service
        return True
    if not decisive:
        return False
    found.sort()
    firsts = [f[0] for f in found]
    at = 0
    for cut in [*SENTENCE.finditer(low), None]:
        stop = cut.start() if cut else len(low)
        words = [(m.start() + at, m.end() + at, m[0]) for m in WORD.finditer(low[at:stop])]
        at = cut.end() if cut else stop
        if not words:
            continue
        latin = sum(w in LATIN for _, _, w in words)
        if len(words) >= 4 and latin >= 0.7 * len(words):
            return True
        hit = [1 in covered[a:b] for a, b, _ in words]
        weight = sum(not h and w not in GLUE for h, (_, _, w) in zip(hit, words))
        matched = sum(h and w != "#" for h, (_, _, w) in zip(hit, words))
        if matched and matched >= COVERAGE * (matched + weight) and (matched >= 2 or len(words) <= 2):
            return True
        inside = found[bisect_left(firsts, words[0][0]) : bisect_left(firsts, words[-1][1])]
        if inside and is_notice(*parts_of(low, words, inside)):
            return True
    return False


def parts_of(low: str, words: list[tuple[int, int, str]], found: list[tuple[int, int, int]]) -> tuple[list[int], list[int]]:
    """Kinds and weight of the stretches of a sentence: the longest parts, from left to right, and the words between
    them. A word weighs 1, function words nothing; in scripts without blanks every four characters weigh as a word."""
    start, stop = words[0][0], words[-1][1]
    begins, ends = [a for a, _, _ in words], [b for _, b, _ in words]
    inside = [f for f in found if f[1] <= stop]
    # Strong kinds go first, then long ones; what overlaps a part that was taken is left.
    inside.sort(key=lambda f: (f[0] - f[1], not f[2] & (FAILURE | REQUEST | TECHNIQUE | VERB)))
    taken = bytearray(stop - start)
    bits, weight = [], []
    for a, b, kind in inside:
        if not any(taken[a - start : b - start]):
            taken[a - start : b - start] = b"\1" * (b - a)
            bits.append(kind)
            n = bisect_right(ends, b) - bisect_left(begins, a)
            weight.append(max(n, -(-(b - a) // 4) if CLOSE.match(low[a:b]) else 1))
    for a, b, w in words:
        left = taken[a - start : b - start].count(0)
        if CLOSE.search(w):
            if left:
                bits.append(0)
                weight.append(-(-left // 4))
        elif left == b - a and w not in GLUE:
            bits.append(0)
            weight.append(1)
    return bits, weight


def _flag(position: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            out = []
            for c in batch.column(position).to_pylist():
                r = known.get(c)
                if r is None:
                    if len(known) > 100_000:
                        known.clear()
                    r = known[c] = is_residue(c)
                out.append(r)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.bool_())], names=[*batch.schema.names, "residue"])

    return run


def flagged(images: DataFrame) -> DataFrame:
    """id, caption_source, caption, residue."""
    rows = images.select(F.col("id").cast("string").alias("id"), F.col("caption_source").cast("string").alias("caption_source"), F.col("caption").cast("string").alias("caption"))
    return rows.where(F.col("id").isNotNull()).mapInArrow(_flag(2), "id string, caption_source string, caption string, residue boolean")


def found(images: DataFrame) -> DataFrame:
    """image_id of captions that are or contain residue."""
    return flagged(images).where("residue").select(F.col("id").alias("image_id")).distinct()


def kept(images: DataFrame) -> DataFrame:
    """image_id, caption: the captions that stay; each id and caption once."""
    return flagged(images).where(~F.col("residue") & (F.length(F.trim("caption")) > 0)).select(F.col("id").alias("image_id"), "caption").distinct()
