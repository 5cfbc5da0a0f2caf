"""Template residue and error-page text: records with unfilled fields or junk in place of content.

Method: a regularised linear classifier over hashed n-grams, length and title features of segments
(paragraphs), with two outputs: the segment is junk (an error message, script notice or filler), or it
holds a template field that was never filled. The words of a segment are its n-grams for the first; for the
second, n-grams of its signs with the shapes of the words between them. Weak labels come from
response-status and stock phrases, and from the syntaxes of template languages; hosts of the records (here
their volumes) are held out to validate, and so are phrases that no label was made from.

A document is junk if the classifier calls every segment of its content junk (headings and the frame of a
site are no content). It has an unfilled field if a segment has signs that may be one, the classifier sees
one there, and an exact check finds it outside code, formulas and quotations; forms that are as well a link
or emphasis count by the classifier alone.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bound of the labelled sample: documents of each stratum (texts with signs, texts of at most ``SHORT``
#: characters, other texts), segments of one document, and segments of one output and label. The classifier is
#: fitted on the driver.
SAMPLE_DOCUMENTS = {"signs": 5_000, "short": 40_000, "other": 3_000}
SHORT, SEGMENTS_EACH, SAMPLE_SEGMENTS = 600, 6, 8_000
#: Hash space of the n-grams, strength of the L2 penalty, passes and probability from which a segment is junk.
DIMENSIONS, PENALTY, PASSES, JUNK_FROM = 1 << 16, 1e-6, 120, 0.5
#: Probability from which a segment is looked at exactly for an unfilled field.
FIELD_FROM = 0.2
#: Power of the inverse size of its class in a row's weight: 1 weighs both classes alike.
POWER = 0.75
#: Folds of hosts; each is held out once to validate.
FOLDS = 5

FENCED = re.compile(r"(?ms)^[ \t]*(```|~~~)[^\n]*\n.*?(?:^[ \t]*\1[ \t]*$|\Z)|\\begin\{(verbatim|lstlisting)\}.*?\\end\{\2\}|<(pre|code)\b[^>]*>.*?</\3>")
INDENTED = re.compile(r"(?m)^(?: {4,}|\t)\S.*$")
CODE_SPAN = re.compile(r"`[^`\n]+`")
QUOTED = re.compile(r"“[^”\n]*”|„[^“”\n]*[“”]|«[^»\n]*»|\"[^\"\n]*\"")
SEGMENT = re.compile(r"(?:\r?\n|\r| | |\x85)[ \t\xa0]*(?:\r?\n|\r| | |\x85)\s*")
WORDS = re.compile(r"[^\W\d_]+|\d+|[{}<>%$@#\[\]]")

# Phrases of error pages, script notices and filler, the weak labels' evidence of junk (Java syntax, lower case).
LABEL_PHRASES = (
    r"\b(?:error|status|http)(?: code)?:? ?[45]\d\d\b",
    r"\b[45]\d\d (?:not found|forbidden|bad gateway|service unavailable|internal server error|too many requests)\b",
    r"\b(?:page|file|url|scan|image|resource)s? not found\b|\b(?:was|were|could) not (?:be )?found\b(?! in\b)",
    r"\b(?:temporarily|currently) unavailable\b",
    r"\bcould not be (?:loaded|processed|displayed|opened)\b",
    r"\btimed out\b",
    r"\baccess denied\b|\bpermission to (?:read|view)\b",
    r"\bno longer (?:here|available)\b",
    r"\bbad gateway\b|\binternal server error\b|\bsomething went wrong\b",
    r"\bfehler:? ?[45]\d\d\b|\berreur:? ?[45]\d\d\b|ошибки:? ?[45]\d\d",
    r"\bnicht gefunden\b|\bnicht verfügbar\b|\bintrouvable\b|страница не найдена",
    r"^traceback \(most recent",
    r"<noscript",
    r"\b(?:enable|allow|requires?|needs?) (?:java ?script|js|scripts|active scripting)\b",
    r"\bjava ?script (?:is |has been )?(?:turned off|disabled|required)\b",
    r"\b(?:activer|activez|aktivieren sie|включите) javascript\b",
    r"\blorem\b.*\b(?:ipsum|dolor)\b|\bipsum\b.*\b(?:lorem|dolor)\b|\bdolor\b.*\b(?:lorem|ipsum)\b",
    r"\b(?:sample|placeholder) (?:text|paragraph)\b|\btexte provisoire\b|\bblindtext\b",
    r"\bfoo bar\b|\btest page\b|\btest test\b",
)
# Phrases that no label is made from; segments that hold them tell how the classifier does on unseen ones.
UNSEEN_PHRASES = (
    r"\bsession has expired\b",
    r"\bchecking your browser\b",
    r"\brate limited\b|\brequest limit\b",
    r"\bdoes not exist on this server\b|\brefused by the server\b",
    r"\b(?:empty|invalid) answer\b",
    r"\bdoes not support scripting\b|\bonly works with scripts\b|\bbuilt with js\b",
    r"\byour text goes here\b",
)
#: A word five times over is filler in any language.
REPEATED = r"\b(\w{2,})(?:\s+\1){4,}\b"
LABELS = re.compile("|".join(LABEL_PHRASES), re.I | re.S)
UNSEEN = re.compile("|".join(UNSEEN_PHRASES), re.I)
AGAIN = re.compile(REPEATED, re.I)

HEADING = re.compile(r"^(?:#{1,6}\s.*|=+ .* =+|\\(?:sub)*section\*?\{[^{}]*\}|(?:page|seite|feuillet|heading|page title|title)\b[\s\d.:()\w-]{0,24})$", re.I)
FRAME = re.compile(r"^(?:[^.!?\n]{1,30}(?:\s[|·•»>/]\s[^.!?\n]{1,30})+|(?:[^\W\d_][\w ]{0,18}\n){1,}[^\W\d_][\w ]{0,18}|skip to (?:main )?content|©.{1,60}|\(c\) .{1,60}|all rights reserved.{0,40})$", re.I)

# Forms of template fields that nothing else looks like; NAME is a field's name.
_NAME = r"[A-Za-z][\w.]{1,40}"
FIELD = re.compile(
    rf"\{{\{{\s*{_NAME}\s*\}}\}}|\{{%\s*{_NAME}\s*%\}}|<%=?\s*{_NAME}\s*%>|<<\s*{_NAME}\s*>>|«\s*{_NAME}\s*»|‹\s*{_NAME}\s*›|\$\{{{_NAME}\}}|#\{{{_NAME}\}}|@@{_NAME}@@|%\({_NAME}\)[sdr]|(?<![\w%])%[A-Za-z][A-Za-z_.]{{2,40}}%(?![\w%])"
    r"|(?<![\w%])%[sd](?![\w%])|(?<![\w$\\])\$(?=[A-Za-z._]{4,40}\$)[A-Za-z][A-Za-z.]*(?:_[A-Za-z.]+)*\$(?![\w$])|(?<!\w)__(?:[A-Z][A-Z_]{2,40}|[a-z]+(?:_[a-z]+)+)__(?!\w)|\[\[\s*(?:[A-Za-z]\w*(?:[_.]\w+)+|TBD|TODO|[A-Z_]{4,})\s*\]\]"
    r"|<(?i:insert|enter|your|fill in)\s[^<>\n]+>|\[(?i:insert|enter|your|fill in|todo|tbd)\b[^\[\]\n]*\]|\[[^\[\]\n]+\b(?i:eintragen|einfügen|einsetzen|here)\]|\[(?i:à compléter|à remplir|compléter|insérer|saisir|заполнить|вставить)\b[^\[\]\n]*\]|\[[A-Za-z][\w.]{1,40}\?\]"
    r"|<[A-Za-z][\w.]{0,40} (?:here|HERE)>|&lt;[A-Z][A-Z_]{2,40}&gt;|<[A-Z]{2,}(?:_[A-Z]+)+>|<[a-z]+(?:_[a-z]+)+>|(?<![\w\\}\]^_$#%{])\{(?:[A-Za-z][\w.]{1,40}|\d{1,2})\}(?![\w{}])|\bXX[/.-]XX[/.-]XXXX\b|\b(?:DD[/.-]MM|MM[/.-]DD|TT[.]MM)[/.-](?:YYYY|JJJJ)\b"
)
# Forms that are a field or a link or emphasis; the classifier tells by the word.
MAYBE_FIELD = re.compile(r"(?<!\w)__[a-z]+__(?!\w)|\[\[\s*[a-z]+\s*\]\]")
#: A sign or word that every field has.
SIGNS = r"[{}$%@<>‹«\[]|__|XX|YYYY|JJJJ|&lt;"
HAS_SIGNS = re.compile(SIGNS)
MATH = re.compile(r"\$\$.*?\$\$|\\\[.*?\\\]|\\\(.*?\\\)|(?<!\\)\$(?=\S)(?![A-Za-z._]+\$)[^$\n]*?[^$\s\\]\$|\\(?:new|renew)command\{[^\n]*", re.S)


def without_code(text: str) -> str:
    """The text without code blocks; indented lines count as code only where they hold code's signs."""
    if "```" in text or "~~~" in text or "\\begin{" in text or "<pre" in text or "<code" in text:
        text = FENCED.sub("\n\n", text)
    if "    " in text or "\t" in text:
        text = INDENTED.sub(lambda m: "" if re.search(r"[(){}=;%]", m[0]) else m[0], text)
    return text


def exact_fields(segment: str) -> tuple[bool, bool]:
    """Whether a segment holds a field for sure, or perhaps one, outside code spans, formulas and quotations."""
    text = CODE_SPAN.sub(" ", segment)
    if "$" in text or "\\" in text:
        text = MATH.sub(" ", text)
    if not FIELD.search(text) and not MAYBE_FIELD.search(text):
        return False, False
    text = QUOTED.sub(lambda q: " " * len(q[0]) if FIELD.search(q[0]) and not FIELD.fullmatch(q[0]) else q[0], text)
    return bool(FIELD.search(text)), bool(MAYBE_FIELD.search(text))


def may_have_field(text: str) -> bool:
    return bool(HAS_SIGNS.search(text)) and bool(FIELD.search(text) or MAYBE_FIELD.search(text))


def segments(text: str) -> Iterator[str]:
    """The paragraphs of a text without its code, one after the other."""
    text, at = without_code(text), 0
    for m in SEGMENT.finditer(text):
        part = text[at : m.start()].strip()
        at = m.end()
        if part:
            yield part
    part = text[at:].strip()
    if part:
        yield part


def titled_segments(text: str) -> Iterator[tuple[str, str, bool]]:
    """(segment, title, is_frame): segments that are no headings, with the heading before them."""
    title = ""
    for s in segments(text):
        if HEADING.match(s):
            title = s
            continue
        head, _, rest = s.partition("\n")
        if rest.strip() and HEADING.match(head):
            title, s = head, rest.strip()
        yield s, title, bool(FRAME.match(s))
        title = ""


# Features.


def bucket(token: str, _seen: dict[str, int] = {}) -> int:  # noqa: B006
    at = _seen.get(token)
    if at is None:
        if len(_seen) > 300_000:
            _seen.clear()
        at = _seen[token] = zlib.crc32(token.encode("utf-8", "replace")) % DIMENSIONS
    return at


def text_features(segment: str, title: str, first: bool) -> list[int]:
    """Hashed features for junk: distinct word 1- and 2-grams, length, variety, and the words of its title."""
    words = ["0" if w.isdigit() else w for w in WORDS.findall(segment.casefold())]
    grams = set(words)
    grams.update(map(" ".join, zip(words, words[1:], strict=False)))
    size = len(words)
    grams.add(f"\x01len{min(9, size.bit_length())}")
    grams.add(f"\x01varied{int(4 * len(set(words)) / max(1, size))}" if size > 5 else "\x01short")
    grams.add(f"\x01first{first:d}")
    if title:
        grams.add("\x01titled")
        grams.update(f"\x01t {w}" for w in WORDS.findall(title.casefold()) if not w.isdigit())
    return [bucket(g) for g in grams]


SIGN_TOKENS = re.compile(r"[^\W_]+(?:[._][^\W_]+)*|\s+|[^\w\s]|_")
# Words that stand for themselves among signs.
STAND_INS = frozenset("XX XXXX DD MM YYYY TT JJJJ TBD TODO".split())


def shape(token: str) -> str:
    """What a token looks like: a sign itself, a blank, or a word by its case, length and inner signs."""
    if token in STAND_INS:
        return token
    if token[0].isalnum():
        if token.isdigit():
            return "0"
        joined = "_" if "_" in token else "." if "." in token else ""
        kind = "W" if token.isupper() else "w" if token.islower() else "Ww"
        return kind[0] + "1" if len(token) == 1 else kind + joined
    return " " if token.isspace() else token


def sign_features(segment: str) -> list[int]:
    """Hashed features for fields: n-grams of two to six tokens' shapes around signs, and the words between signs."""
    tokens = SIGN_TOKENS.findall(CODE_SPAN.sub("`c`", segment) if "`" in segment else segment)
    shapes = [shape(t) for t in tokens]
    odd = [k for k, t in enumerate(tokens) if not (t[0].isalnum() or t[0] in " \n.,;:!?-'") or t in STAND_INS]
    grams = set()
    n = len(shapes)
    for k in odd:
        for size in range(2, 7):
            for a in range(max(0, k - size + 1), min(k, n - size) + 1):
                grams.add("\x02" + "\x03".join(shapes[a : a + size]))
    for k, t in enumerate(tokens):
        if t[0].isalnum() and (k > 0 and tokens[k - 1][0] in "{[<«‹$%@(_" or k + 1 < n and tokens[k + 1][0] in "}]>»›$%@)_"):
            grams.add("\x02in " + t.casefold())
    return [bucket(g) for g in grams]


@dataclass
class Classifier:
    """Weights of a logistic model over hashed features."""

    weights: np.ndarray
    bias: float

    def probability(self, x: list[int]) -> float:
        z = float(self.weights[x].sum()) / max(1, len(x)) ** 0.5 + self.bias
        return 1 / (1 + 2.718281828459045 ** -max(-30.0, min(30.0, z)))

    def probabilities(self, rows: list[list[int]]) -> np.ndarray:
        return np.array([self.probability(r) for r in rows])


def fit(rows: list[list[int]], labels: np.ndarray) -> Classifier:
    """L2-regularised logistic regression, all rows at once by Adam, classes weighted alike."""
    w, bias = np.zeros(DIMENSIONS), 0.0
    if not len(labels):
        return Classifier(w, -5.0)
    sizes = np.array([len(r) for r in rows])
    at = np.fromiter((i for r in rows for i in r), np.int64, int(sizes.sum()))
    used, at = np.unique(at, return_inverse=True)
    row = np.repeat(np.arange(len(rows)), sizes)
    scale = 1 / np.sqrt(np.maximum(sizes, 1))
    weight = ((len(labels) / (2 * np.maximum(np.bincount(labels, minlength=2), 1))) ** POWER)[labels]
    v = np.zeros(len(used) + 1)
    m, s = np.zeros_like(v), np.zeros_like(v)
    for t in range(1, PASSES + 1):
        z = np.bincount(row, v[at], len(rows)) * scale + v[-1]
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels) * weight
        grad = np.append(np.bincount(at, (g * scale)[row], len(used)) / len(rows) + PENALTY * v[:-1], g.sum() / len(rows))
        m, s = 0.9 * m + 0.1 * grad, 0.99 * s + 0.01 * grad * grad
        v -= 0.3 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-8)
    w[used] = v[:-1]
    return Classifier(w, float(v[-1]))


# Labels.


def label_of(segment: str) -> int:
    """1: a phrase of junk; -2: a phrase that no label is made from; 0: neither."""
    words = segment.casefold().split()
    again = any(a == b for a, b in zip(words, words[1:], strict=False)) and AGAIN.search(segment)
    return 1 if again or LABELS.search(segment) else -2 if UNSEEN.search(segment) else 0


SEGMENT_ROW = T.StructType([
    T.StructField("order", T.LongType()), T.StructField("host", T.StringType()), T.StructField("output", T.StringType()), T.StructField("segment", T.StringType()),
    T.StructField("title", T.StringType()), T.StructField("first", T.BooleanType()), T.StructField("label", T.IntegerType()),
])


def labelled(text: str) -> Iterator[tuple[str, str, str, bool, int]]:
    """(output, segment, title, first, label) of a text; a phrase beside other content tells neither way and is left out."""
    content = [(s, title, k == 0) for k, (s, title, frame) in enumerate(titled_segments(text)) if not frame]
    labels = [label_of(s) for s, _, _ in content]
    for (s, title, first), y in zip(content, labels, strict=True):
        if y == 0 or 0 not in labels:
            yield "text", s, title, first, y
    if HAS_SIGNS.search(text):
        for s in segments(text):
            if HAS_SIGNS.search(s):
                sure, maybe = exact_fields(s) if may_have_field(s) else (False, False)
                if sure or not maybe:
                    yield "sign", s, "", False, int(sure)


def stratum(text: Column) -> Column:
    """``signs``: texts with what every field has (as ``SIGNS``); else ``short`` or ``other``."""
    signs = text.rlike(r"[{}$%@<>‹«\[]")
    for word in ("__", "XX", "YYYY", "JJJJ", "&lt;"):
        signs = signs | text.contains(word)
    return F.when(signs, "signs").when(F.char_length(text) <= SHORT, "short").otherwise("other")


def labelled_sample(documents: DataFrame, text: str = "text", host: str = "volume_id") -> pd.DataFrame:
    """Labelled segments of a bounded sample of the documents: of each stratum those of the least hashes.

    All documents are counted by stratum; only the sample's leave the JVM. Equal texts are labelled once
    in each task, so that one that makes up a third of the rows adds no more than its own segments.
    """
    t = F.col(text)
    d = documents.select(t.alias("_t"), F.coalesce(F.col(host), F.lit("")).alias("_h"), F.xxhash64(t).alias("_x"), stratum(t).alias("_s")).filter(F.length(F.trim(t)) > 0)
    sizes = {r["_s"]: r["n"] for r in d.groupBy("_s").agg(F.count("*").alias("n")).collect()}  # three rows
    keep = F.lit(False)
    for name, n in sizes.items():
        keep = keep | ((F.col("_s") == name) & (F.pmod("_x", F.lit(1 << 30)) < int((1 << 30) * min(1.0, SAMPLE_DOCUMENTS[name] / n))))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for b in batches:
            rows = []
            for s, h, x in zip(b["_t"], b["_h"], b["_x"], strict=True):
                if x not in seen:
                    seen.add(x)
                    each = [(zlib.crc32(r[1].encode("utf-8", "replace")), h, *r) for r in labelled(s)]
                    for output in ("text", "sign"):
                        rows += sorted(r for r in each if r[2] == output)[:SEGMENTS_EACH]
            yield pd.DataFrame(rows, columns=SEGMENT_ROW.names)

    rows = d.filter(keep).select("_t", "_h", "_x").mapInPandas(run, SEGMENT_ROW).toPandas()  # bounded by the sample's documents and segments of each
    rows = rows.drop_duplicates(["output", "segment", "title"]).sort_values(["order", "host", "segment"], kind="stable")
    return rows.groupby(["output", "label"]).head(SAMPLE_SEGMENTS).reset_index(drop=True)


def _fold(hosts: pd.Series) -> np.ndarray:
    return np.array([zlib.crc32(h.encode()) % FOLDS for h in hosts], np.int64)


def agreement(said: np.ndarray, truth: np.ndarray) -> dict[str, float]:
    hits = float((said & truth).sum())
    return {"rows": float(len(truth)), "positive": float(truth.sum()), "precision": hits / max(1.0, float(said.sum())), "recall": hits / max(1.0, float(truth.sum()))}


def by_unseen_hosts(rows: list[list[int]], labels: np.ndarray, folds: np.ndarray) -> np.ndarray:
    """The probability of each row by a classifier fitted on the other folds' hosts."""
    said = np.zeros(len(labels))
    for k in range(FOLDS):
        here = folds == k
        if here.any():
            part = fit([r for r, h in zip(rows, here, strict=True) if not h], labels[~here])
            said[here] = part.probabilities([r for r, h in zip(rows, here, strict=True) if h])
    return said


def training_rows(sample: pd.DataFrame, output: str) -> tuple[list[list[int]], np.ndarray, pd.Series]:
    """Features, labels and hosts of an output's segments."""
    part = sample[sample["output"] == output]
    if output == "text":
        x = [text_features(s, t, f) for s, t, f in zip(part["segment"], part["title"], part["first"], strict=True)]
    else:
        x = [sign_features(s) for s in part["segment"]]
    return x, part["label"].to_numpy(np.int64), part["host"]


def train(sample: pd.DataFrame) -> tuple[Classifier, Classifier]:
    """The classifier's two outputs, fitted on all labels; the phrases held apart in ``validate`` count as junk."""
    (x, y, _), (xs, ys, _) = training_rows(sample, "text"), training_rows(sample, "sign")
    return fit(x, (y != 0).astype(np.int64)), fit(xs, ys)


def validate(sample: pd.DataFrame) -> dict[str, dict[str, float]]:
    """How the classifier does on hosts and phrases it was not fitted on.

    ``junk`` and ``field``: agreement with the labels of unseen hosts. ``unseen``: with segments of phrases
    that no label was made from, by a classifier that has seen none of them on any host.
    """
    scores: dict[str, dict[str, float]] = {}
    x, y, hosts = training_rows(sample, "text")
    named = y >= 0
    x_named = [r for r, u in zip(x, named, strict=True) if u]
    scores["junk"] = agreement(by_unseen_hosts(x_named, y[named], _fold(hosts[named])) >= JUNK_FROM, y[named] == 1)
    without = fit(x_named, y[named])
    unseen = without.probabilities([r for r, u in zip(x, named, strict=True) if not u])
    scores["unseen"] = agreement(unseen >= JUNK_FROM, np.ones(len(unseen), bool))
    xs, ys, hosts = training_rows(sample, "sign")
    scores["field"] = agreement(by_unseen_hosts(xs, ys, _fold(hosts)) >= JUNK_FROM, ys == 1)
    return scores


# Verdicts.


def judge(text: str | None, junk: Classifier, field: Classifier) -> tuple[bool, str | None, float]:
    """Whether a text is junk, why (``field`` or ``junk``) and the probability that decided."""
    if text is None or not text.strip():
        return False, None, 0.0
    if may_have_field(text):
        for s in segments(text):
            if may_have_field(s) and (p := field.probability(sign_features(s))) >= FIELD_FROM:
                sure, maybe = exact_fields(s)
                if sure or maybe and p >= JUNK_FROM:
                    return True, "field", p
    least, found = 1.0, False
    for k, (s, title, frame) in enumerate(titled_segments(text)):
        p = junk.probability(text_features(s, title, k == 0))
        if p >= JUNK_FROM:
            found, least = True, min(least, p)
        elif not frame:
            return False, None, p
    return (True, "junk", least) if found else (False, None, 0.0)


VERDICT = T.StructType([T.StructField("is_junk", T.BooleanType()), T.StructField("reason", T.StringType()), T.StructField("score", T.DoubleType())])


def with_verdict(documents: DataFrame, text: str = "text", host: str = "volume_id") -> DataFrame:
    """The table with a struct column ``verdict`` (is_junk, reason, score).

    Null, empty and blank texts are not junk. The fitted weights (half a megabyte, whatever the data)
    travel with the function. Repeated rows are judged alike; without labelled junk or fields none is found.
    """
    junk, field = train(labelled_sample(documents, text, host))
    packed = [(m.weights.astype(np.float32), m.bias) for m in (junk, field)]

    @F.pandas_udf(VERDICT)
    def verdict(texts: pd.Series) -> pd.DataFrame:
        models = [Classifier(w, b) for w, b in packed]
        return pd.DataFrame([judge(t if isinstance(t, str) else None, *models) for t in texts], columns=VERDICT.names)

    return documents.withColumn("verdict", verdict(F.col(text)))


def without_residue(documents: DataFrame, text: str = "text", host: str = "volume_id") -> DataFrame:
    """The documents that are not junk."""
    return with_verdict(documents, text, host).filter(~F.col("verdict.is_junk")).drop("verdict")
