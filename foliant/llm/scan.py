"""Noise in text from scanned pages: furniture, broken words and misread words; continuous paragraphs.

Method: skip-gram vectors are learned over all lines. A word's vector is the mean of vectors of its
n-grams, and these are taken over the strokes of its glyphs, so that words that look alike share most of
them; pairs of neighbouring lexicon words are counted on the cluster, and the skip-gram objective with
negative samples, which depends on the texts only through those counts, is fitted on the driver for a
bounded number of slots that all known words share. A rare stored word is linked to the frequent printed
ones (the lexicon's) that are neighbours of its vector and that plausible glyph edits turn it into: a walk
through a trie of the lexicon that allows look-alike glyphs, glyphs run together or apart and stray marks.
A word is corrected in context, by edit cost and by how well the candidate's vector fits the words around
it. Then running titles and page numbers are removed, words broken at line and page ends are joined, and
lines are set as paragraphs.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.llm.lookalikes import by_letters
from foliant.session import kept
from foliant.sources.tables import only_current

#: Slots of the vectors' vocabulary: the most frequent half of them hold a word each, the others share the rest by
#: hash. Buckets of n-grams, the vectors' size, and how far apart neighbours may be.
SLOTS, BUCKETS, VECTOR_SIZE, WINDOW = 2_048, 1 << 13, 32, 2
#: Cosine from which a word's vector is a neighbour of another's.
NEAR = 0.4
#: Lexicon entries up to which the lexicon travels to every task as a trie; more are refused.
LEXICON_BOUND = 1_000_000
#: Weight of the context beside the cost of the edits, and the context that a doubtful edit needs.
CONTEXT_WEIGHT, DOUBTFUL_CONTEXT = 0.35, -1.5

# Glyphs or pairs of glyphs as read, and what may have been printed; read left to right only.
MISREAD_GLYPHS = (
    "6 h|u ri|d ci|d el|b li|il ü|li ü|ni rü|c e|e c|f t|t f|u n|n u|l i|i l|0 o|o 0|1 l|1 i|l 1|5 s|9 g|6 b|6 é|b h|h b|B ß|b ss|cl d|c1 d|d cl|rn m|ru m|m rn|vv w|w vv|ii ü|n ri|ri n|u ii|h li|li h|nn m|in m|m in|m ni|a ä|a â|a à|e é|e è|e ê|o ö|o ô|u ü|i î|"
    "8 b|3 e|4 a|7 t|2 z|q g|g q|g 9|s 5|c o|o c|c ç|н и|и н|н п|п н|е с|с е|п л|л п|н л|ё е|е ё|ш щ|щ ш|ь ъ|3 з|0 о|о 0|6 б|б 6|rc re|cn en|fi ti|tt ff|ff tt"
)
#: What a scan puts into a word, and what it puts in place of a glyph that it can't read.
STRAYS, UNREAD = frozenset("'^~;.,|`·:*!\"’‘"), frozenset("01ci.")
NUMBER_LIKE = re.compile(r"[\dOolISsBbZz|iI.,]*\d[\dOolISsBbZz|iI.,]*")
SHARP_S = re.compile(r"(?<=[^\W\d_A-Z])B")  # a capital within a word is no capital
MARKUP = re.compile(r"[\\<>{}()\[\]&#/=_$@%+]|''")
SIGNS = r"[-¬=‐­]"
# Words after a suspended compound.
AFTER_SUSPENDED = ("und", "oder", "bzw", "and", "or", "et", "ou", "и", "или")
#: Body lines that stand within a text without being part of its flow: numbers alone, blocks of markup.
ASIDE = r"^(?:[^\p{L}]*$|\\(?:begin|end|item|chapter|section|subsection)\b|\\\[|\$\$|\{?\||!\s|```|~~~|#{1,6}\s|={2,6}\s.*=$|>\s|[+*-]\s|\w+ = |\w+\(.*\)$)"
PAGE_NUMBER = r"^[^\p{L}\p{N}]*(?:(?i:pp?|page|seite|s|стр)[.\s]*)?[0-9IVXLCivxlcOoSsBZ|]{1,7}[^\p{L}\p{N}]*$"


def norm(c: Column) -> Column:
    """Case, outer punctuation and invisible characters set aside, as the lexicon has its words."""
    inner = F.regexp_replace(F.regexp_replace(c, r"\p{Cf}", ""), r"^[^\p{L}\p{M}\p{N}]+|[^\p{L}\p{M}\p{N}]+$", "")
    return F.translate(F.regexp_replace(F.lower(inner), "ß", "ss"), "ς", "σ")


def quick_norm(c: Column) -> Column:
    """What ``norm`` gives for a word in plain characters with a stop or comma at most; else something unknown."""
    return F.translate(F.replace(F.lower(F.btrim(c, F.lit(".,;:"))), F.lit("ß"), F.lit("ss")), "ς", "σ")


def py_norm(w: str) -> str:
    return re.sub(r"^[\W_]+|[\W_]+$", "", w).casefold()


# Page layout.


def laid_out(lines: DataFrame) -> DataFrame:
    """The current lines in page order, each with its kind: header, pageno, foot or body.

    A header is a page's first line, set smaller than the text and apart from it; without a box, one whose
    letters are those of another page's header of the volume. A page number is a line of nothing but a
    number at a page's end or top, apart or off the margin. Lines without a file, page or line index are body.
    """
    box = F.col("bbox")
    cols = [F.col(c) for c in ("line_id", "hocr_id", "volume_id", "page_idx", "line_idx", "page_num")] + [box["x0"].alias("x0"), box["y0"].alias("y0"), box["x1"].alias("x1"), box["y1"].alias("y1"), F.trim(F.coalesce("ocr_line", F.lit(""))).alias("text"), F.col("loaded_at")]
    page = Window.partitionBy("hocr_id", "page_idx")
    same = Window.partitionBy("hocr_id", "page_idx", "line_id").orderBy(F.col("loaded_at").desc_nulls_last(), "text")
    order = page.orderBy("line_idx", "line_id")
    placed = F.col("hocr_id").isNotNull() & F.col("page_idx").isNotNull() & F.col("line_idx").isNotNull()
    every = lines.select(*cols)
    df = every.filter(placed).repartition("hocr_id", "page_idx").withColumn("_r", F.row_number().over(same)).filter("_r = 1").drop("_r")
    # a line delivered again at another place counts where it was delivered last
    where = F.xxhash64("hocr_id", "page_idx", "line_idx")
    twice = every.groupBy("line_id").agg(F.min(where).alias("a"), F.max(where).alias("b")).filter("a <> b").select(F.col("line_id").alias("_l"))
    moved = every.select("line_id", "loaded_at", "hocr_id", "page_idx", "line_idx").join(twice, F.col("line_id").eqNullSafe(F.col("_l"))).groupBy("_l").agg(F.max(F.struct("loaded_at", F.struct("hocr_id", "page_idx", "line_idx").alias("at")))["at"].alias("at"))
    here = F.struct("hocr_id", "page_idx", "line_idx").eqNullSafe(F.col("at"))
    df = df.join(moved, F.col("line_id").eqNullSafe(F.col("_l")), "left").filter(F.col("_l").isNull() | here).drop("_l", "at", "loaded_at")
    # without a place there is no layout: such lines are body, each by itself
    lost = every.filter(~placed).groupBy("line_id").agg(F.max(F.struct("loaded_at", *(c for c in every.columns if c not in ("line_id", "loaded_at")))).alias("l")).select("line_id", "l.*").drop("loaded_at")
    nowhere = F.col("at.hocr_id").isNull() | F.col("at.page_idx").isNull() | F.col("at.line_idx").isNull()
    lost = lost.join(moved, F.col("line_id").eqNullSafe(F.col("_l")), "left").filter(F.col("_l").isNull() | nowhere).drop("_l", "at")
    lost = lost.withColumn("rank", F.lit(1)).withColumn("n", F.lit(1).cast("long")).withColumn("kind", F.lit("body"))
    df = df.withColumn("h", F.col("y1") - F.col("y0"))
    df = df.select(
        "*",
        F.row_number().over(order).alias("rank"), F.count("*").over(page).alias("n"), F.median("h").over(page).alias("med"), F.min("x0").over(page).alias("left"), F.max("x1").over(page).alias("right"),
        F.expr("lead(y0) IGNORE NULLS OVER (PARTITION BY hocr_id, page_idx ORDER BY line_idx, line_id)").alias("y_next"), F.expr("lag(y1) IGNORE NULLS OVER (PARTITION BY hocr_id, page_idx ORDER BY line_idx, line_id)").alias("y_last"),
    )
    number = F.col("text").rlike(PAGE_NUMBER)
    apart_above = F.coalesce(F.col("y0") - F.col("y_last") > 1.2 * F.col("med"), F.lit(False))
    apart_below = F.coalesce(F.col("y_next") - F.col("y1") > 1.2 * F.col("med"), F.lit(False))
    off_margin = F.coalesce(F.col("x0") - F.col("left") > 0.25 * (F.col("right") - F.col("left")), F.lit(False))
    no_box = F.col("y0").isNull()
    ends = (F.col("rank") == F.col("n")) & (apart_above | off_margin | no_box | (F.col("n") == 1))
    starts = (F.col("rank") == 1) & (apart_below | no_box) & (F.col("n") > 1)
    small = F.coalesce(F.col("h") < 0.95 * F.col("med"), F.lit(False))
    header = (F.col("rank") == 1) & (F.col("n") > 1) & small & F.coalesce(F.col("y_next") - F.col("y1") > F.col("h"), F.lit(False))
    foot = F.coalesce(F.col("h") < 0.85 * F.col("med"), F.lit(False)) & (F.col("rank") > 1)
    kind = F.when(number & (ends | starts), "pageno").when(header, "header").when(foot, "foot").otherwise("body")
    df = kept(df.withColumn("kind", kind).drop("y_next", "y_last", "h", "med", "left", "right").unionByName(lost))  # laid out once
    letters = F.lower(F.regexp_replace("text", r"[^\p{L}]", ""))
    unsure = (F.col("kind") == "body") & F.col("line_idx").isNotNull() & (F.col("rank") == 1) & F.col("y0").isNull() & (F.col("n") > 1) & (F.length(letters) > 5)
    if not df.filter(unsure).take(1):
        return df  # most volumes: every first line has a box, nothing is left to be joined
    titles = df.filter(F.col("kind") == "header").groupBy("volume_id", letters.alias("_t")).agg(F.count("*").alias("_times"))
    known = df.filter(unsure).select("line_id", "volume_id", letters.alias("_t")).join(titles, ["volume_id", "_t"]).filter(F.col("_times") > 1).select("line_id", F.lit(True).alias("_known")).distinct()
    return kept(df.join(known, "line_id", "left").withColumn("kind", F.when(F.col("_known"), "header").otherwise(F.col("kind"))).drop("_known"))


def with_toks(laid: DataFrame) -> DataFrame:
    """The lines with their words; split where they are used, so that no table holds the text twice."""
    return laid.withColumn("toks", F.filter(F.split("text", r"[\s\p{Z}]+"), lambda t: F.length(t) > 0))


#: Files of a volume in one part of the order over its pages.
FILES_PER_PART = 4_096


def next_on_page(body: DataFrame) -> DataFrame:
    """Lines of text or foot notes with the line of their kind that they go on with: on the page, else on the volume's next page.

    A volume may hold any share of all pages: its files are ordered in parts of ``FILES_PER_PART`` ids, and
    only the first page of each part takes part in the order over a volume.
    """
    order = Window.partitionBy("hocr_id", "page_idx", "kind").orderBy("line_idx", "line_id")
    here = body.select("*", F.lead(F.struct("line_id", "tok")).over(order).alias("nxt"), F.row_number().over(order).alias("_b"))
    part = F.floor(F.col("hocr_id") / FILES_PER_PART)
    firsts = here.filter("_b = 1").select("volume_id", "hocr_id", "page_idx", "kind", part.alias("part"), F.struct("line_id", "tok").alias("head"))
    pages = Window.partitionBy("volume_id", "kind", "part").orderBy("hocr_id", "page_idx")
    linked = firsts.select("*", F.lead("head").over(pages).alias("after"), F.row_number().over(pages).alias("_p"))
    heads = linked.filter("_p = 1").select("volume_id", "kind", "part", "head")
    over_parts = heads.select(F.col("volume_id").alias("_v"), F.col("kind").alias("_k"), F.col("part").alias("_n"), F.lead("head").over(Window.partitionBy("volume_id", "kind").orderBy("part")).alias("_next_part"))
    linked = linked.join(over_parts, F.col("volume_id").eqNullSafe(F.col("_v")) & (F.col("kind") == F.col("_k")) & (F.col("part") == F.col("_n")), "left")
    linked = linked.select("hocr_id", "page_idx", "kind", F.coalesce("after", "_next_part").alias("page_after"))
    return here.join(linked, ["hocr_id", "page_idx", "kind"], "left").withColumn("nxt", F.coalesce("nxt", "page_after")).drop("page_after", "_b")


# Glyph edits.


class Trie:
    """The lexicon as a trie, with a walk that allows misread glyphs."""

    def __init__(self, words: list[str]):
        self.root: dict = {}
        self.walked: dict[tuple[str, int], list[tuple[str, float]]] = {}
        self.words = frozenset(words)
        for w in self.words:
            node = self.root
            for ch in w:
                node = node.setdefault(ch, {})
            node[""] = w
        self.printed: dict[str, list[str]] = {}
        for pair in MISREAD_GLYPHS.split("|"):
            read, real = pair.casefold().split(" ")
            if read != real:
                self.printed.setdefault(read, []).append(real)

    def is_prefix(self, s: str) -> bool:
        node = self.root
        for ch in s:
            node = node.get(ch)
            if node is None:
                return False
        return True

    def candidates(self, form: str, limit: int = 3) -> list[tuple[str, float]]:
        """Lexicon words that at most ``limit`` glyph edits make of a form, cheapest first; a known form has none."""
        size = len(form)
        if size < 2 or form in self.words:
            return []
        if (known := self.walked.get((form, limit))) is not None:
            return known
        most = min(limit, 1 if size <= 3 else 2 if size <= 7 else 3)
        best: dict[str, float] = {}
        todo = [(0, self.root, 0, 0.0, False)]
        seen: dict[tuple[int, int], float] = {}
        while todo:
            at, node, edits, cost, guessed = todo.pop()
            key = (at, id(node))
            if seen.get(key, 99.0) <= cost:
                continue
            seen[key] = cost
            if at == size:
                w = node.get("")
                if w is not None and len(w) > 1 and cost < best.get(w, 99.0):
                    best[w] = cost
                continue
            ch = form[at]
            step = node.get(ch)
            if step is not None:
                todo.append((at + 1, step, edits, cost, guessed))
            if edits >= most:
                continue
            if ch in STRAYS:
                todo.append((at + 1, node, edits + 1, cost + 1.0, guessed))
            for span in (1, 2):
                for real in self.printed.get(form[at : at + span], ()) if at + span <= size else ():
                    step = node
                    for c in real:
                        step = step.get(c)
                        if step is None:
                            break
                    if step is not None:
                        todo.append((at + span, step, edits + 1, cost + 1.0, guessed))
            if ch in UNREAD and not guessed and size > 3 and edits + 1 <= most:
                for c, step in node.items():
                    if c and c != ch:
                        todo.append((at + 1, step, edits + 1, cost + 1.7, True))
        found = sorted(best.items(), key=lambda x: (x[1], x[0]))
        if len(self.walked) > 100_000:
            self.walked.clear()
        self.walked[form, limit] = found
        return found


def readings(word: str, trie: Trie, vectors: Vectors, limit: int = 3) -> list[tuple[str, float]] | None:
    """What a stored word may have been printed as: words near its vector that glyph edits make of it; none for markup, numbers and inconsistent characters."""
    if MARKUP.search(word):
        return None
    if not word.isascii() and by_letters(word)[0] != word:
        return None
    n = py_norm(word)
    if len(n) < 2 or NUMBER_LIKE.fullmatch(py_norm_keep_case(word)) or not any(c.isalpha() for c in n):
        return None
    found = trie.candidates(n, limit)
    return vectors.linked(py_norm(SHARP_S.sub("ß", word)), found) or None if found else None


def py_norm_keep_case(w: str) -> str:
    return re.sub(r"^[\W_]+|[\W_]+$", "", w)


READINGS = T.ArrayType(T.StructType([T.StructField("word", T.StringType()), T.StructField("cost", T.FloatType())]))


def readings_udf(words: list[str], vectors: Vectors, limit: int = 3):
    """Readings of distinct forms; the lexicon, of a checked size, and the n-grams' vectors travel with the function."""
    made: list[Trie] = []

    @F.pandas_udf(READINGS)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if not made:
            made.append(Trie(words))
        for s in batches:
            yield pd.Series([readings(w, made[0], vectors, limit) for w in s], dtype=object)

    return run


def listed(spark: SparkSession, words: list[str], name: str = "w") -> DataFrame:
    """Words of a checked number as a table in the plan itself: reading it takes no tasks."""
    return spark.createDataFrame(pa.table({name: pa.array(words, pa.string())}))


def lexicon_words(lexicon: DataFrame) -> list[str]:
    rows = lexicon.select("word").filter(F.length("word") > 0).distinct().limit(LEXICON_BOUND + 1).collect()
    if len(rows) > LEXICON_BOUND:
        raise ValueError(f"the lexicon has more than {LEXICON_BOUND} words")
    return sorted(r.word for r in rows)


# Skip-gram vectors.


# Strokes of the glyphs that are misread for each other; others stand for themselves.
STROKES = (
    ("i", "ijl1tfr!|ïîíй7"), ("ii", "nuüипнлñ"), ("iii", "mшщ"), ("c", "ceoaçéèêëäâàöôóёе0346сзб"), ("ci", "d"), ("ic", "bh8"), ("s", "s5"), ("g", "gq9"), ("z", "z2"), ("vv", "w"),
)
STROKE_OF = {ord(glyph): strokes for strokes, glyphs in STROKES for glyph in glyphs} | {ord(c): "" for c in STRAYS}


def grams(word: str) -> list[int]:
    """Buckets of the n-grams (1 to 4) of a word's strokes, and of the whole."""
    s = f"<{word.translate(STROKE_OF)}>"
    parts = [s[i : i + k] for k in range(1, 5) for i in range(len(s) - k + 1)]
    return [zlib.crc32(g.encode("utf-8", "replace")) % BUCKETS for g in (*(p for p in parts if p not in "<>"), s[1:-1] + "\x01")]


def slot(word: str, rank: int) -> int:
    """A word's slot in the vectors' vocabulary by its rank: its own, or one shared by hash."""
    return rank if rank < SLOTS // 2 else SLOTS // 2 + zlib.crc32(word.encode("utf-8", "replace")) % (SLOTS - SLOTS // 2)


def token_counts(laid: DataFrame) -> DataFrame:
    """(t, n, n_body): words of all lines as they stand, and how often, in all lines and in those of the text."""
    each = laid.select((F.col("kind") == "body").alias("is_body"), F.explode(F.split("text", " ")).alias("t"))
    return kept(each.groupBy("t").agg(F.count("*").alias("n"), F.count_if("is_body").alias("n_body")))


def pair_counts(laid: DataFrame, tokens: DataFrame, words: list[str]) -> tuple[dict[str, int], dict[str, int], np.ndarray]:
    """Counts of known words, their slots, and counts of neighbouring words within ``WINDOW`` over all lines of the text, by slots."""
    spark = laid.sparkSession
    known = listed(spark, words)
    plain = lambda c: F.replace(F.replace(F.lower(c), F.lit("ß"), F.lit("ss")), F.lit("ς"), F.lit("σ"))
    counted = tokens.groupBy(F.rtrim(plain("t"), F.lit(".,;:")).alias("w")).agg(F.sum("n_body").alias("n")).filter("n > 0").join(F.broadcast(known), "w").collect()  # no more rows than the checked lexicon
    count = {r.w: r.n for r in sorted(counted, key=lambda r: (-r.n, r.w))}
    slots = {w: slot(w, k) for k, w in enumerate(count)}
    size = max(slots.values(), default=-1) + 1
    # pairs are counted by the words' hashes, as words stand in lower case with a stop or comma or without
    seq = laid.filter(F.col("kind") == "body").select(F.split(plain("text"), " ").alias("s"))
    ahead = [F.arrays_zip(F.col("s").alias("a"), F.slice("s", k + 1, F.size("s")).alias("b")) for k in range(1, WINDOW + 1)]
    pairs = seq.filter(F.size("s") > 1).select(F.explode(F.concat(*ahead)).alias("p")).filter(F.col("p.b").isNotNull()).select(F.xxhash64("p.a").alias("a"), F.xxhash64("p.b").alias("b"))
    forms = [(w + sign, k) for w, k in slots.items() for sign in ("", ".", ",", ";", ":")]
    at = spark.createDataFrame(pa.table({"v": pa.array([f for f, _ in forms], pa.string()), "k": pa.array([k for _, k in forms], pa.int32())})).select(F.xxhash64("v").alias("v"), "k")
    by_word = pairs.groupBy("a", "b").agg(F.count("*").alias("n"))
    by_slot = by_word.join(F.broadcast(at.select(F.col("v").alias("a"), F.col("k").alias("i"))), "a").join(F.broadcast(at.select(F.col("v").alias("b"), F.col("k").alias("j"))), "b").groupBy("i", "j").agg(F.sum("n").alias("n"))
    n = np.zeros((size, size), np.float32)
    if size:
        got = by_slot.toPandas()  # at most SLOTS squared
        np.add.at(n, (got["i"].to_numpy(), got["j"].to_numpy()), got["n"].to_numpy())
    return count, slots, n + n.T


@dataclass
class Vectors:
    """Vectors of n-grams and of slots as context; a word's is the mean of its n-grams', set off from the mean of all."""

    ngrams: np.ndarray
    context: np.ndarray
    slots: dict[str, int]
    middle: np.ndarray

    made: dict[str, np.ndarray] = field(default_factory=dict)

    def of(self, word: str) -> np.ndarray:
        x = self.made.get(word)
        if x is None:
            if len(self.made) > 50_000:
                self.made.clear()
            x = self.made[word] = self.ngrams[grams(word)].mean(0)
        return x

    def linked(self, form: str, found: list[tuple[str, float]]) -> list[tuple[str, float]]:
        """The words that are neighbours of a form."""
        x = self.of(form) - self.middle
        out = []
        for w, cost in found:
            y = self.of(w) - self.middle
            size = float(np.sqrt((x @ x) * (y @ y)))
            if size > 0 and float(x @ y) >= NEAR * size:
                out.append((w, cost))
        return out

    def fit(self, word: str, around: list[str]) -> float | None:
        """How well a word fits the known words around it; none without any."""
        near = [self.slots[x] for x in around if x in self.slots]
        return float((self.context[near] @ self.of(word)).mean()) if near else None


def skip_gram(n: np.ndarray, slots: dict[str, int], count: dict[str, int], size: int = VECTOR_SIZE, negatives: int = 5, steps: int = 120, seed: int = 11) -> Vectors:
    """Vectors that maximise the skip-gram objective with negative samples for pair counts; words that share a slot weigh by their counts."""
    v = len(n)
    rng = np.random.default_rng(seed)
    g = rng.normal(0, 1 / np.sqrt(size), (BUCKETS, size)).astype(np.float32)
    c = rng.normal(0, 0.1, (v, size)).astype(np.float32)
    made = np.zeros((v, BUCKETS), np.float32)
    for w, k in slots.items():
        parts = grams(w)
        np.add.at(made[k], parts, count[w] / len(parts))
    made /= np.maximum(made.sum(1, keepdims=True), 1e-9)
    if v and n.sum() > 0:
        row = n.sum(1)
        noise = row**0.75 / (row**0.75).sum()
        scale = n + negatives * np.outer(row, noise) + 1e-9
        root = np.sqrt(scale)
        both = (g, c)
        m, s = [np.zeros_like(x) for x in both], [np.zeros_like(x) for x in both]
        for t in range(1, steps + 1):
            w = made @ g
            p = 1 / (1 + np.exp(-np.clip(w @ c.T, -20, 20)))
            d = ((scale * p - n) / root).astype(np.float32)  # positives pull up, negatives down; damped for frequent pairs
            for k, grad in enumerate((made.T @ (d @ c) / v, d.T @ w / v + 1e-3 * c)):
                m[k] = 0.9 * m[k] + 0.1 * grad
                s[k] = 0.99 * s[k] + 0.01 * grad * grad
                both[k][...] -= 0.05 * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.99**t)) + 1e-8)
    middle = (made @ g).mean(0) if v else np.zeros(size, np.float32)
    return Vectors(g, c, slots, middle)


CHOICE = T.StructType([T.StructField("word", T.StringType()), T.StructField("score", T.FloatType())])


def choose_udf(vectors: Vectors):
    """The reading that fits best: its edits' cost against its vector's fit with the words around."""

    @F.pandas_udf(CHOICE)
    def run(cands: pd.Series, around: pd.Series) -> pd.DataFrame:
        out = []
        for rows, near in zip(cands, around, strict=True):
            best: tuple[float, str | None] = (-1e9, None)
            for r in rows:
                fit = vectors.fit(r["word"], near if near is not None else [])
                fit = -0.5 if fit is None else fit
                if r["cost"] > 1.5 and len(r["word"]) < 5 and fit < DOUBTFUL_CONTEXT:
                    continue
                score = CONTEXT_WEIGHT * fit - r["cost"]
                if score > best[0]:
                    best = (score, r["word"])
            out.append((best[1], best[0] if best[1] else None))
        return pd.DataFrame(out, columns=["word", "score"])

    return run


# Broken words.


def broken_lines(laid: DataFrame, known: DataFrame, words: list[str], tokens: DataFrame, vectors: Vectors) -> DataFrame:
    """(line_id, hocr_id, page_idx, next_id, t1, t2, marked) of lines whose last word goes on in the next line of the text, or of its foot notes.

    With a sign: every word but a compound parted at its own hyphen and a suspended compound. Without: if
    the two parts together are a known word or a frequent name, or a misread known word, and not both parts
    are known words; a line that starts with a capital goes on only after a word in capitals.
    """
    flow = laid.filter(F.col("kind").isin("body", "foot") & F.col("line_idx").isNotNull() & F.col("hocr_id").isNotNull() & F.col("page_idx").isNotNull() & ~F.col("text").rlike(ASIDE))
    body = next_on_page(with_toks(flow).select("line_id", "hocr_id", "page_idx", "volume_id", "line_idx", "kind", F.get("toks", F.lit(0)).alias("tok"), F.try_element_at("toks", F.lit(-1)).alias("t1")))
    d = body.filter(F.col("t1").isNotNull()).select("line_id", "hocr_id", "page_idx", F.col("nxt.line_id").alias("next_id"), "t1", F.col("nxt.tok").alias("t2"))
    d = d.filter(F.col("t1").rlike(r"[\p{L}\p{M}]" + SIGNS + r"?$")).withColumn("marked", F.col("t1").rlike(SIGNS + "$"))
    capital = F.col("t2").rlike(r"^[^\p{L}]*\p{Lu}") & ~F.col("t1").rlike(r"\p{Lu}\p{Lu}")
    d = d.filter(F.col("marked") | (~F.coalesce(capital, F.lit(False)) & F.col("t2").rlike(r"^[\p{L}\p{M}]")))
    flag = lambda c: F.broadcast(known.select(F.col("w").alias(c), F.lit(True).alias(f"k_{c}")))  # noqa: E731  # of checked size
    d = d.withColumn("q1", quick_norm("t1")).withColumn("q2", quick_norm("t2")).join(flag("q1"), "q1", "left").join(flag("q2"), "q2", "left")
    d = d.filter(F.col("marked") | F.col("k_q1").isNull() | F.col("k_q2").isNull()).drop("q1", "q2", "k_q1", "k_q2")  # most lines end here, before any pattern
    d = d.select("*", norm("t1").alias("n1"), F.coalesce(norm("t2"), F.lit("")).alias("n2"))
    d = d.withColumn("joined", F.concat("n1", "n2")).withColumn("compound", F.concat("n1", F.lit("-"), "n2"))
    names = (
        tokens.filter(F.col("t").rlike(r"^[\p{Lu}][\p{L}]{4,}[.,;:]?$"))
        .groupBy(norm("t").alias("joined")).agg(F.sum("n").alias("_n")).filter(F.col("_n") >= 8).select("joined", F.lit(True).alias("is_name"))
    )
    for c in ("joined", "n1", "n2", "compound"):
        d = d.join(flag(c), c, "left")
    d = d.join(names, "joined", "left").na.fill(False, ["k_joined", "k_n1", "k_n2", "k_compound", "is_name"])
    d = kept(d.filter("marked OR k_joined OR is_name OR NOT k_n2"))
    whole = F.col("k_joined") | F.col("is_name")
    suspended = F.col("n2").isin(*AFTER_SUSPENDED) & ~whole
    with_sign = F.col("marked") & (F.length("n1") > 0) & ~(F.col("k_compound") & ~F.col("k_joined")) & ~suspended
    without = ~F.col("marked") & (F.length("n2") > 0) & whole & ~(F.col("k_n1") & F.col("k_n2"))
    maybe = ~F.col("marked") & ~whole & ~F.col("k_n2") & (F.length("joined") > 5) & F.col("n2").rlike(r"^[\p{L}\p{M}\p{N}^~;.,|'`]+$")
    sure = d.filter(with_sign | without)
    tries = d.filter(maybe)
    # one edit at most: two parts that two edits make a word are too often two words
    read = tries.select("joined").distinct().withColumn("r", readings_udf(words, vectors, 1)("joined")).filter(F.col("r").isNotNull()).select("joined")
    misread = tries.join(read, "joined")
    names_out = ["line_id", "hocr_id", "page_idx", "next_id", "t1", "t2", "marked"]
    return sure.select(names_out).unionByName(misread.select(names_out)).dropDuplicates(["line_id"])


# Misread words.


def as_printed(words: list[str]) -> list[str]:
    """Lexicon words as they mostly stand in a text: in three cases, with a stop or comma or without; fifteen forms of each at most."""
    return sorted({case + sign for w in words for case in (w, w.capitalize(), w.upper()) for sign in ("", ".", ",", ";", ":")})


def unknown_rows(df: DataFrame, known: DataFrame, plain: DataFrame, keys: list[str], word: str) -> DataFrame:
    """Rows with a letter in their word and a word that the lexicon has not; ``plain`` has lexicon words as printed."""
    lexicon = F.broadcast(known)  # of checked size, and plain fifteen times that at most
    rows = df.select(*keys, F.col(word).alias("word"), "loaded_at").join(F.broadcast(plain.withColumn("_plain", F.lit(True))), "word", "left")
    may_be = (F.length("word") > 1) & F.col("word").rlike(r"[\p{L}]") & ~F.col("word").rlike(r"[\\<>{}()\[\]&#/=_$@%+]|[\p{L}\p{M}]" + SIGNS + "$")
    # one condition on both sides, so that the patterns run behind the join, where most words are gone; a filter on w would run before it
    rows = rows.filter(F.when(F.col("_plain").isNull(), may_be).otherwise(F.col("_plain").isNull())).drop("_plain").withColumn("w", norm("word"))
    return rows.join(lexicon, "w", "left_anti")


def _set_right(stored: Column, reading: Column) -> Column:
    """The reading in the stored word's case, between its outer punctuation; without a reading the word itself."""
    inner = F.regexp_replace(stored, r"^[^\p{L}\p{M}\p{N}]+|[^\p{L}\p{M}\p{N}]+$", "")
    cased = F.when(inner.rlike(r"^[^\p{Ll}]*\p{Lu}[^\p{Ll}]*\p{Lu}[^\p{Ll}]*$"), F.upper(reading)).when(inner.rlike(r"^\p{Lu}"), F.concat(F.upper(F.substring(reading, 1, 1)), F.substring(reading, F.lit(2), F.length(reading)))).otherwise(reading)
    before, after = F.regexp_extract(stored, r"^[^\p{L}\p{M}\p{N}]*", 0), F.regexp_extract(stored, r"[^\p{L}\p{M}\p{N}]*$", 0)
    return F.when(reading.isNull(), stored).otherwise(F.concat(before, cased, after))


class Pages:
    """What the queries about a volume's noise share: lines laid out, broken words, the lexicon, vectors."""

    def __init__(self, lines: DataFrame, lexicon: DataFrame):
        self.words = lexicon_words(lexicon)
        self.known = listed(lines.sparkSession, self.words)
        self.laid = laid_out(lines)
        tokens = token_counts(self.laid)
        count, slots, pairs = pair_counts(self.laid, tokens, self.words)
        self.vectors = skip_gram(pairs, slots, count)
        self.broken = kept(broken_lines(self.laid, self.known, self.words, tokens, self.vectors))

    def furniture(self) -> DataFrame:
        """(kind, row_id) of headers and page numbers."""
        return self.laid.filter(F.col("kind").isin("header", "pageno")).select("kind", F.col("line_id").alias("row_id"))

    def flagged(self, rows: DataFrame) -> DataFrame:
        """Rows of words with their line's id, and whether the line starts or ends with part of a broken word."""
        ends = self.broken.select("line_id", F.lit(True).alias("ends_broken"))
        starts = self.broken.select(F.col("next_id").alias("line_id"), F.lit(True).alias("starts_broken")).distinct()
        return rows.join(ends, "line_id", "left").join(starts, "line_id", "left").na.fill(False, ["ends_broken", "starts_broken"])

    def paragraphs(self, corrections: DataFrame | None = None) -> DataFrame:
        """(hocr_id, page_idx, paragraph, text): the volume's text as continuous paragraphs.

        Headers and page numbers are gone, broken words joined, and words corrected where ``corrections``
        (hocr_id, page_idx, line_idx, word_idx, word, reading) has them. A paragraph starts at an indented
        line, after a gap, and around headings and foot notes; what a page opens with belongs to the last
        paragraph of the pages before it in the volume, over any number of pages. A paragraph bears the place
        where it starts; a line without a place is a paragraph by itself, with a null number.
        """
        page = Window.partitionBy("hocr_id", "page_idx")
        order = page.orderBy("line_idx", "line_id")
        placed = F.col("hocr_id").isNotNull() & F.col("page_idx").isNotNull() & F.col("line_idx").isNotNull()
        text_lines = self.laid.filter(F.col("kind").isin("body", "foot")).select("line_id", "volume_id", "hocr_id", "page_idx", "line_idx", "x0", "y0", "y1", "text", "kind")
        d = text_lines.filter(placed)
        high = F.col("y1") - F.col("y0")
        d = d.select("*", F.min(F.when(F.col("kind") == "body", F.col("x0"))).over(page).alias("left"), F.median(high).over(page).alias("med"))
        d = d.withColumn("big", F.coalesce(high > 1.3 * F.col("med"), F.lit(False)))
        d = d.select("*", F.lag("big").over(order).alias("big_before"), F.lag("y1").over(order).alias("y1_before"))
        gap = F.coalesce(F.col("y0") - F.col("y1_before") > 1.5 * F.col("med"), F.lit(False))
        starts = F.coalesce(F.col("x0") - F.col("left") > 25, F.lit(False)) | gap | (F.col("kind") == "foot") | (F.col("big") != F.coalesce("big_before", F.lit(False)))
        d = d.withColumn("paragraph", F.sum(starts.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
        d = d.withColumn("_last", F.max(F.when(F.col("kind") == "body", F.col("paragraph"))).over(page)).drop("left", "med", "big", "big_before", "y1_before")
        d = self._with_open_paragraph(d)
        opens = (F.col("paragraph") == 0) & F.col("before").isNotNull()
        home = F.when(opens, F.col("before")).otherwise(F.struct(F.col("hocr_id").alias("h"), F.col("page_idx").alias("p"), F.col("paragraph").cast("long").alias("k")))
        d = with_toks(d.withColumn("home", home))
        # what belongs to a page's lines comes to them by page, as they lie: its broken lines, and its corrections by the word's
        # place in its line; where the line's words are not those of the table, by the word, if it has one reading there
        at_page = self.broken.groupBy("hocr_id", "page_idx").agg(F.collect_set("line_id").alias("broken"))
        if corrections is not None:
            each = corrections.filter("word_idx IS NOT NULL").select("hocr_id", "page_idx", "line_idx", F.col("word_idx").cast("int").alias("at"), "word", "reading").dropDuplicates(["hocr_id", "page_idx", "line_idx", "at", "word"])
            by_word = corrections.groupBy("hocr_id", "page_idx", "line_idx", "word").agg(F.max("reading").alias("reading"), F.min("reading").alias("_other")).filter("reading = _other").select("hocr_id", "page_idx", "line_idx", F.lit(-1).alias("at"), "word", "reading")
            fixes = each.unionByName(by_word).groupBy("hocr_id", "page_idx").agg(F.map_from_entries(F.collect_list(F.struct(F.struct(F.col("line_idx").cast("int").alias("line"), "at", "word"), "reading"))).alias("fixes"))
            at_page = at_page.join(fixes, ["hocr_id", "page_idx"], "full")
            key = lambda at, t: F.struct(F.col("line_idx").cast("int").alias("line"), at.alias("at"), t.alias("word"))
            fixed = F.transform("toks", lambda t, i: _set_right(t, F.coalesce(F.try_element_at("fixes", key(i, t)), F.try_element_at("fixes", key(F.lit(-1), t)))))
            d = d.join(at_page, ["hocr_id", "page_idx"], "left").withColumn("toks", F.when(F.col("fixes").isNotNull(), fixed).otherwise(F.col("toks"))).drop("fixes")
        else:
            d = d.join(at_page, ["hocr_id", "page_idx"], "left")
        said = F.array_join("toks", " ")
        ends_broken = F.coalesce(F.array_contains("broken", F.col("line_id")), F.lit(False))
        d = d.withColumn("said", F.when(ends_broken, F.regexp_replace(said, SIGNS + "$", "")).otherwise(F.concat(said, F.lit(" "))))
        parts = F.array_sort(F.collect_list(F.struct("hocr_id", "page_idx", "line_idx", "line_id", "said")))
        g = d.groupBy("home").agg(F.trim(F.array_join(F.transform(parts, lambda x: x["said"]), "")).alias("text"))
        lost = text_lines.filter(~placed).select("hocr_id", "page_idx", F.lit(None).cast("long").alias("paragraph"), "text")
        return g.select(F.col("home.h").alias("hocr_id"), F.col("home.p").alias("page_idx"), F.col("home.k").alias("paragraph"), "text").unionByName(lost)

    @staticmethod
    def _with_open_paragraph(d: DataFrame) -> DataFrame:
        """Lines with the paragraph (file, page, number) that is open where their page begins; none on a volume's first page.

        It is the last one of the nearest page before that starts any, else the one the volume begins with.
        A volume's pages are ordered in parts, and of each part one row takes part in the order over the volume.
        """
        pages = d.groupBy("volume_id", "hocr_id", "page_idx").agg(F.max("_last").cast("long").alias("k")).withColumn("part", F.floor(F.col("hocr_id") / FILES_PER_PART))
        place = F.struct(F.col("hocr_id").alias("h"), F.col("page_idx").alias("p"), "k")
        w = Window.partitionBy("volume_id", "part").orderBy("hocr_id", "page_idx").rowsBetween(Window.unboundedPreceding, -1)
        pages = pages.select("*", F.when(F.col("k") > 0, place).alias("starts"), F.when(F.col("k").isNotNull(), place).alias("has_text"))
        here = pages.select("*", F.last("starts", ignorenulls=True).over(w).alias("before"))
        parts = pages.groupBy("volume_id", "part").agg(F.max("starts").alias("tail"), F.min("has_text").alias("head"))
        v = Window.partitionBy("volume_id").orderBy("part")
        over = parts.select(F.col("volume_id").alias("_v"), F.col("part").alias("_p"), F.last("tail", ignorenulls=True).over(v.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"), F.first("head", ignorenulls=True).over(v.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_first"))
        linked = here.join(over, F.col("volume_id").eqNullSafe(F.col("_v")) & (F.col("part") == F.col("_p")), "left")
        later = F.struct("hocr_id", "page_idx") > F.struct(F.col("_first.h").alias("hocr_id"), F.col("_first.p").alias("page_idx"))
        linked = linked.select("hocr_id", "page_idx", F.coalesce("before", "_before", F.when(later, F.col("_first"))).alias("before"))
        return d.drop("_last").join(linked.filter(F.col("before").isNotNull()), ["hocr_id", "page_idx"], "left")

    def misread(self, ocr_words: DataFrame, word_csv: DataFrame | None) -> DataFrame:
        """(kind, row_id, hocr_id, page_idx, line_idx, word_idx, word, reading) of misread words of both tables, or the first, corrected in context."""
        plain = listed(self.known.sparkSession, as_printed(self.words), "word")
        rows_a = kept(unknown_rows(ocr_words, self.known, plain, ["word_id", "hocr_id", "page_idx", "line_idx", "word_idx"], "ocrx_word"))
        rows_b = kept(unknown_rows(word_csv, self.known, plain, ["csv_id", "filename", "left_x", "upper_y"], "word")) if word_csv is not None else None
        forms = rows_a.select("word", "w")
        forms = forms if rows_b is None else forms.unionByName(rows_b.select("word", "w"))
        forms = forms.filter(F.length("w") > 1).distinct().repartition("w")  # forms of one word in one task
        read = kept(forms.withColumn("r", readings_udf(self.words, self.vectors)("word")).filter(F.col("r").isNotNull()))
        rows_a = only_current(rows_a.drop("w").join(read, "word"), ocr_words, "word_id").drop("loaded_at").dropDuplicates(["word_id"])
        lines = self.laid.select("line_id", "volume_id", "hocr_id", "page_idx", "page_num", "line_idx", "x0", "y0", "x1", "text", F.col("kind").alias("line_kind"), (F.col("rank") == F.col("n")).alias("is_last"))

        a = self.flagged(with_toks(rows_a.join(lines, ["hocr_id", "page_idx", "line_idx"], "left")))
        is_first = F.col("word_idx") == 0
        is_last = (F.col("word_idx") >= F.size("toks") - 2) & (F.try_element_at("toks", F.lit(-1)) == F.col("word"))
        a = self._kept(a, is_first, is_last).select(F.lit("misread_word").alias("kind"), F.col("word_id").alias("row_id"), "hocr_id", "page_idx", "line_idx", "word_idx", "word", "r", self._around(F.col("word_idx")).alias("around"))

        both = a if rows_b is None else a.unionByName(self._export_words(rows_b, read, word_csv, lines))
        chosen = both.withColumn("c", choose_udf(self.vectors)("r", "around"))
        return chosen.filter(F.col("c.word").isNotNull()).select("kind", "row_id", "hocr_id", "page_idx", "line_idx", "word_idx", "word", F.col("c.word").alias("reading"))

    def _export_words(self, rows_b: DataFrame, read: DataFrame, word_csv: DataFrame, lines: DataFrame) -> DataFrame:
        """Words of the export that may be misread, at the lines that their image and height name."""
        name = r"^(.*)_(\d+)\.[A-Za-z0-9]+$"
        rows_b = only_current(rows_b.drop("w").join(read, "word"), word_csv, "csv_id").drop("loaded_at").dropDuplicates(["csv_id"])
        b = rows_b.withColumn("volume_id", F.regexp_extract("filename", name, 1)).withColumn("page_no", F.regexp_extract("filename", name, 2).try_cast("int"))
        number = F.col("page_num").try_cast("int")
        shift = lines.groupBy("hocr_id").agg(F.max(number - F.col("page_idx")).alias("shift"))  # page numbers run on within a file
        placed = lines.filter(F.col("y0").isNotNull()).join(shift, "hocr_id").withColumn("page_no", F.coalesce(number, F.col("shift") + F.col("page_idx")))
        near = (F.col("upper_y") >= F.col("y0") - 8) & (F.col("upper_y") <= F.col("y0") + 16)
        hits = b.join(placed.select("volume_id", "page_no", "line_id", "x0", "y0", "x1", "text", "line_kind", "is_last"), ["volume_id", "page_no"]).filter(near)
        best = hits.groupBy("csv_id").agg(F.min(F.struct(F.abs(F.col("upper_y") - F.col("y0")).alias("d"), "line_id", "x0", "x1", "text", "line_kind", "is_last")).alias("line"))
        b = self.flagged(with_toks(b.select("csv_id", "word", "r", "left_x").join(best.select("csv_id", "line.*").drop("d"), "csv_id", "left")))
        per_sign = (F.col("x1") - F.col("x0")) / F.greatest(F.length("text"), F.lit(1))
        is_first = F.coalesce(F.abs(F.col("left_x") - F.col("x0")) <= 8, F.lit(False))
        is_last = F.coalesce(F.col("left_x") + per_sign * F.length("word") >= F.col("x1") - 2 * per_sign, F.lit(False))
        place = F.round((F.col("left_x") - F.col("x0")) / (F.col("x1") - F.col("x0")) * F.size("toks"))
        return self._kept(b, is_first, is_last).select(F.lit("misread_csv").alias("kind"), F.col("csv_id").alias("row_id"), *(F.lit(None).cast(t).alias(c) for c, t in (("hocr_id", "long"), ("page_idx", "int"), ("line_idx", "int"), ("word_idx", "int"))), "word", "r", self._around(place).alias("around"))

    @staticmethod
    def _kept(df: DataFrame, is_first: Column, is_last: Column) -> DataFrame:
        """Without words of furniture and parts of broken or cut words."""
        furniture = F.coalesce(F.col("line_kind").isin("header", "pageno"), F.lit(False))
        part = F.coalesce((F.col("ends_broken") & is_last) | (F.col("starts_broken") & is_first), F.lit(False))
        doubtful = (F.get("r", F.lit(0))["cost"] > 1.0) & (F.length("word") <= 5)
        cut = F.coalesce(F.col("is_last") & is_last & doubtful, F.lit(False)) | F.col("word").rlike(r"(?:…|\.\.+)$")
        return df.filter(~furniture & ~part & ~cut)

    @staticmethod
    def _around(place: Column) -> Column:
        """Known forms of the words around a place in its line."""
        first = F.greatest(F.coalesce(place.cast("int"), F.lit(0)) - WINDOW, F.lit(0))
        return F.transform(F.slice(F.coalesce("toks", F.array().cast("array<string>")), first + 1, F.lit(2 * WINDOW + 1)), quick_norm)


def noise(lines: DataFrame, ocr_words: DataFrame, word_csv: DataFrame, lexicon: DataFrame) -> DataFrame:
    """(kind, row_id): headers, page numbers, lines that end in a broken word, and misread words."""
    pages = Pages(lines, lexicon)
    hyphens = pages.broken.select(F.lit("hyphen").alias("kind"), F.col("line_id").alias("row_id"))
    return pages.furniture().unionByName(hyphens).unionByName(pages.misread(ocr_words, word_csv).select("kind", "row_id")).distinct()


def continuous_text(lines: DataFrame, ocr_words: DataFrame, lexicon: DataFrame) -> DataFrame:
    """(hocr_id, page_idx, paragraph, text): all volumes as repaired paragraphs."""
    pages = Pages(lines, lexicon)
    fixes = pages.misread(ocr_words, None).filter("hocr_id IS NOT NULL").select("hocr_id", "page_idx", "line_idx", "word_idx", "word", "reading")
    return pages.paragraphs(kept(fixes))  # used by word and by place
