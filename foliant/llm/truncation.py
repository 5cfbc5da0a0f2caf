"""Text cut off by field limits or in transfer: truncated pages, and the share of them by source.

Method: trigrams inside texts against trigrams at their ends, in pure SQL. The final trigram of every
page is joined with the counts of all pages; a page was cut if its final trigram goes on often inside
pages and almost never ends one. Since books go on over the page, words alone do not tell an end: the
trigrams are taken at two levels.

* **Markup.** The words are a page's tags, each with whether text or blank follows. Pages end in the
  trigrams that close them, which never stand inside; a page that stops in its text, in a tag or before
  its elements are closed ends in a trigram that goes on everywhere else. An unfinished last tag is
  matched as the beginning of a word.
* **Words.** Pages whose markup was closed after the cut end in part of a word: after the same two words,
  else the same word, else anywhere, longer words with its letters stand inside, and the part hardly or
  never. A page that ends between two words was cut if what its last words are followed by is nearly all
  known (the share of followers seen once tells how often a new one is due), the next page starts with
  none of it, and other pages do not usually end with its final trigram.

A closing trigram under which most pages end in part of a word is a repair's: all its pages were cut. So
were pages of exactly the length at which a source's pages mostly stop by their markup (a field limit).

Everything is built from Spark's SQL expressions; no row goes through Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.llm.scan import FILES_PER_PART, PAGE_NUMBER, norm
from foliant.session import kept
from foliant.sources.tables import only_current

#: Times a word must stand inside lines to count as known; pages that make a field limit or a closing style.
KNOWN_FROM, LIMIT_FROM = 4, 4
#: Share of a final trigram's stops in its stops and continuations up to which it is almost never terminal.
TERMINAL_SHARE = 0.4
#: Lines of the next page that are tried as its start (running titles come first), and how often a follower
#: may be due that was never seen, for a seam without a known one to tell a cut.
STARTS, NEW_DUE = 3, 0.02
#: Share of a last word, beside the words that go on from its letters, up to which it is a fragment.
FRAGMENT_SHARE = 0.2
#: Share of a form in the words that begin with its letters up to which it is no word, but what cuts and misreadings left of them.
NOISE_SHARE = 0.01
#: Marks that producers put behind a page's end; they tell nothing by themselves.
END_MARKS = r"(?:\s*(?:…|\.\.+|\x{FFFD}+|\[(?:\.{3}|…)\]|\((?:cont|forts|suite)\.?\)))+\s*$"
#: Stands for the unfinished end of a tag, and between the parts of a context.
UNFINISHED, AND = "?", "\x1f"
#: Marks of a line, and of its box, in a page's text while it is taken apart.
_LINE, _BOX = "\x01", "\x02"


def page_texts(hocr: DataFrame) -> DataFrame:
    """One row per non-empty page: its lengths, its tags as words, and its lines with their boxes.

    The page is split at its tags once. A comment counts as one tag; an unfinished tag or comment at the
    end bears the mark ``UNFINISHED`` and what there is of its name.
    """
    keys = ["hocr_id", "volume_id", "ocr_system", "loaded_at", "page_idx", "chars", "bytes"]
    blanks = F.lit(" \t\r\n")
    pages = hocr.select("hocr_id", "volume_id", "ocr_system", "loaded_at", F.posexplode("pages_html").alias("page_idx", "html")).filter(F.length(F.trim("html")) > 0)
    pages = pages.withColumn("chars", F.char_length("html")).withColumn("bytes", F.octet_length("html")).withColumn("t", F.rtrim("html", blanks))
    # each pattern runs only over the pages that may need it
    pages = pages.withColumn("t", F.when(F.substring("t", -1, 1).isin("…", ".", "\ufffd", "]", ")"), F.regexp_replace("t", END_MARKS, "")).otherwise(F.col("t")))
    pages = pages.withColumn("t", F.when(F.col("t").contains(_LINE) | F.col("t").contains(_BOX), F.translate("t", _LINE + _BOX, "")).otherwise(F.col("t")))
    d = pages.select(*keys, "t", F.split("t", "<").alias("c"))
    odd = F.exists("c", lambda x: x.startswith("!--") & ~F.substring_index(x, ">", 1).endswith("--"))  # a comment with a bracket in it, or cut
    one_word = F.regexp_replace(F.regexp_replace("t", r"(?s)<!--.*?-->", "<!-->"), r"(?s)<!--(?!>).*$", "<!--")
    d = d.select(*keys, F.when(odd, F.split(one_word, "<")).otherwise(F.col("c")).alias("c"))
    d = d.select(*keys, F.get("c", F.lit(0)).alias("first"), F.size("c").alias("n"), F.transform(F.slice("c", 2, F.size("c")), lambda x: F.split(x, ">", 2)).alias("c"))
    last = F.col("n") - 2

    def chunk(x: Column, i: Column) -> Column:
        head, after = x[0], F.get(x, F.lit(1))
        # the commonest tags are told by their first letters
        name = F.when(head == "/span", "/span").when(head.startswith("span "), "span").when(head.startswith("!--"), "!--").otherwise(F.lower(F.substring_index(F.substring_index(F.substring_index(head, " ", 1), "\n", 1), "\t", 1)))
        may_be_blank = after.startswith("\n") | after.startswith(" ") | after.startswith("\t") | after.startswith("\r")
        behind = F.when(after == "", "").when(~may_be_blank, "·w").when(F.btrim(after, blanks) == "", "·b").otherwise("·w")
        word = F.when(after.isNotNull(), F.concat(name, behind)).when(i == last, F.concat(F.lit(UNFINISHED), name))
        is_line = ~head.startswith("/") & head.contains("ocr_line") & head.rlike(r"(?i)^(?:span|div|p)\b.*?\bocr_line\b")
        box = F.when(is_line, F.concat(F.lit(_LINE), F.regexp_extract(head, r"bbox (\d+ \d+ \d+ \d+)", 1), F.lit(_BOX))).otherwise(" ")
        said = F.when(after.isNotNull(), F.concat(box, after)).when(i == last, box).otherwise(F.concat(F.lit("<"), head))
        return F.struct(word.alias("word"), said.alias("said"))

    d = d.withColumn("x", F.transform("c", chunk))
    opens = F.when(F.btrim("first", blanks) != "", F.array(F.lit("^"), F.lit("^"), F.lit("text·w"))).otherwise(F.array(F.lit("^"), F.lit("^")))
    tags = F.concat(opens, F.filter(F.col("x.word"), lambda w: w.isNotNull()))
    text = F.concat("first", F.array_join(F.col("x.said"), ""))
    for reference, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        text = F.replace(text, F.lit(reference), F.lit(sign))
    d = d.select(*keys, tags.alias("tags"), text.alias("t"))
    tidy = lambda x: F.trim(F.regexp_replace(x, r"[\s\p{Z}]+", " "))
    number = lambda box, k: F.get(F.split(box, " "), F.lit(k)).try_cast("int")

    def line(x: Column) -> Column:
        box = F.substring_index(x, _BOX, 1)
        return F.struct(number(box, 0).alias("x0"), number(box, 1).alias("y0"), number(box, 3).alias("y1"), F.trim(F.substring_index(x, _BOX, -1)).alias("text"))

    none = F.lit(None).cast("int")
    boxed = F.transform(F.slice(F.split(tidy(F.col("t")), _LINE), 2, F.length("t")), line)
    loose = F.transform(F.split("t", "\n"), lambda x: F.struct(none.alias("x0"), none.alias("y0"), none.alias("y1"), tidy(x).alias("text")))
    lines = F.filter(F.when(F.col("t").contains(_LINE), boxed).otherwise(loose), lambda x: F.length(x["text"]) > 0)
    return d.select(*keys, "tags", lines.alias("lines"))


# Trigrams of markup.


def markup_trigrams(pages: DataFrame) -> DataFrame:
    """(x, y, z, inside, ends): trigrams of tags within pages and at their ends, over all pages."""
    n = F.size("tags")
    three = F.arrays_zip(F.col("tags").alias("x"), F.slice("tags", 2, n).alias("y"), F.slice("tags", 3, n).alias("z"))
    each = pages.filter(n >= 3).select((n - 3).alias("_end"), F.posexplode(three).alias("_i", "t")).filter(F.col("t.z").isNotNull())
    end = F.col("_i") == F.col("_end")
    return each.groupBy("t.x", "t.y", "t.z").agg(F.count_if(~end).alias("inside"), F.count_if(end).alias("ends"))


def markup_verdicts(trigrams: DataFrame) -> DataFrame:
    """(x, y, z, stops, goes_on, is_cut) of each final trigram.

    It goes on wherever its first two tags are followed, inside a page, by its third or by one that begins
    with it; an unfinished tag also where a page ends with the finished one, and if its first two tags are
    followed by none, wherever any tag begins with it.
    """
    prefixes = F.transform(F.sequence(F.lit(0), F.length("z")), lambda k: F.substring("z", F.lit(1), k))
    finished = trigrams.filter(~F.col("z").startswith(UNFINISHED))
    on = finished.select("x", "y", F.explode(prefixes).alias("part"), "inside", "ends").groupBy("x", "y", "part").agg(F.sum("inside").alias("inside_on"), F.sum("ends").alias("ends_on"))
    unfinished = F.col("z").startswith(UNFINISHED)
    final = trigrams.filter("ends > 0").select("x", "y", "z", F.col("ends").alias("stops"), F.when(unfinished, F.substring("z", 2, F.length("z"))).otherwise(F.col("z")).alias("part"))
    anywhere = on.groupBy("part").agg(F.sum(F.col("inside_on") + F.col("ends_on")).alias("anywhere"))
    d = final.join(on, ["x", "y", "part"], "left").join(anywhere, "part", "left").na.fill(0, ["inside_on", "ends_on", "anywhere"])
    there = F.col("inside_on") + F.col("ends_on")
    goes_on = F.when(~unfinished, F.col("inside_on")).when(there > 0, there).otherwise(F.col("anywhere"))
    return d.select("x", "y", "z", "stops", goes_on.alias("goes_on")).withColumn("is_cut", (F.col("goes_on") > 0) & (F.col("stops") / (F.col("stops") + F.col("goes_on")) <= TERMINAL_SHARE))


# Trigrams of words.


def with_ends(pages: DataFrame) -> DataFrame:
    """The words at a page's start and end, and what kind of line ends it."""
    heights = F.array_sort(F.filter(F.transform("lines", lambda x: x["y1"] - x["y0"]), lambda h: h.isNotNull()))
    d = pages.withColumn("hs", heights).withColumn("med", F.get("hs", (F.size("hs") / 2).cast("int"))).drop("hs").withColumn("n", F.size("lines"))
    first, second, last, before = F.get("lines", F.lit(0)), F.get("lines", F.lit(1)), F.get("lines", F.col("n") - 1), F.get("lines", F.col("n") - 2)
    high = lambda x: x["y1"] - x["y0"]
    yes = lambda c: F.coalesce(c, F.lit(False))
    header = yes((F.col("n") > 1) & (high(first) < 0.95 * F.col("med")) & (second["y0"] - first["y1"] > high(first)))
    left = F.array_min(F.transform("lines", lambda x: x["x0"]))
    pageno = last["text"].rlike(PAGE_NUMBER) & (F.col("n") > 1) & (yes(last["y0"] - before["y1"] > 1.2 * F.col("med")) | yes(last["x0"] - left > 150) | last["y0"].isNull())
    foot = yes((F.col("n") > 1) & (high(last) < 0.85 * F.col("med")))
    start = F.when(header, second).otherwise(first)
    worded = F.filter(F.transform(F.slice("lines", F.when(header, 2).otherwise(1), STARTS), lambda x: F.split(x["text"], " ")), lambda s: F.exists(s, lambda t: t.rlike(r"[\p{L}\p{N}]")))
    starts = F.transform(worded, lambda s: norm(F.get(F.filter(s, lambda t: t.rlike(r"[\p{L}\p{N}]")), F.lit(0))))
    tail = F.split(F.regexp_replace(last["text"], END_MARKS, ""), " ")
    prior = F.split(F.coalesce(before["text"], F.lit("")), " ")
    words = F.when(F.size(tail) >= 3, tail).otherwise(F.concat(F.when(F.col("n") > F.when(header, 2).otherwise(1), prior).otherwise(F.array().cast("array<string>")), tail))
    return d.select(
        "hocr_id", "volume_id", "ocr_system", "loaded_at", "page_idx", "chars", "bytes", *(F.get("tags", F.size("tags") - k).alias(c) for k, c in ((3, "x"), (2, "y"), (1, "z"))),
        F.when(pageno, "pageno").when(foot, "foot").otherwise("body").alias("ends_with"),
        F.get(F.split(start["text"], " "), F.lit(0)).alias("start"), starts.alias("starts"), yes(high(start) > 1.3 * F.col("med")).alias("starts_heading"),
        F.get(words, F.size(words) - 1).alias("last"), norm(F.get(words, F.size(words) - 2)).alias("w1"), norm(F.get(words, F.size(words) - 3)).alias("w2"),
    )


def inner_trigrams(pages: DataFrame) -> DataFrame:
    """(a, b, c, n, ends): how often three words stand side by side inside a line, and at a page's end."""
    lines = pages.select(F.size("lines").alias("_n"), F.posexplode("lines").alias("_i", "l")).select((F.col("_i") == F.col("_n") - 1).alias("is_last"), F.col("l.text").alias("text"))
    said = F.when(F.col("is_last"), F.regexp_replace("text", END_MARKS, "")).otherwise(F.col("text"))
    plain = F.translate(F.replace(F.lower(said), F.lit("ß"), F.lit("ss")), "ς", "σ")
    toks = lines.select("is_last", F.transform(F.split(plain, " "), lambda t: F.btrim(t, F.lit(".,;:"))).alias("s"))  # as quick_norm has it
    n = F.size("s")
    three = F.arrays_zip(F.col("s").alias("a"), F.slice("s", 2, n).alias("b"), F.slice("s", 3, n).alias("c"))
    each = toks.filter(n >= 3).select("is_last", (n - 3).alias("_end"), F.posexplode(three).alias("_i", "t")).filter(F.col("t.c").isNotNull())
    end = F.col("is_last") & (F.col("_i") == F.col("_end"))
    return each.groupBy("t.a", "t.b", "t.c").agg(F.count_if(~end).alias("n"), F.count_if(end).alias("ends"))


def broken_seams(seam: DataFrame, tri: DataFrame) -> DataFrame:
    """(hocr_id, page_idx) of pages (hocr_id, page_idx, w2, w1, w, starts) that the volume's next page does not go on from.

    What follows the last two words decides, or else what follows the last one: if hardly a follower is new
    to it by the share of those seen once, and none of the next page's starts is one seen inside. A start
    that is no known word, a misreading or markup, leaves a page undecided, and so does a final trigram
    that ends pages more often than it stands inside.
    """
    inside = tri.filter("n > 0")
    known = inside.groupBy(F.col("c").alias("n1")).agg(F.sum("n").alias("_n")).filter((F.col("_n") >= KNOWN_FROM) & (F.length("n1") > 0)).select("n1", F.lit(True).alias("k_n1"))
    pairs = inside.groupBy("a", "b").agg(F.sum("n").alias("n"), F.count_if(F.col("n") == 1).alias("once"))
    singles = pairs.groupBy(F.col("a").alias("w")).agg(F.sum("n").alias("n_1"), F.count_if(F.col("n") == 1).alias("once_1"))
    due = lambda n, once: F.coalesce((F.col(once) + 1) / (F.col(n) + 1) <= NEW_DUE, F.lit(False))
    d = seam.join(pairs.select(F.col("a").alias("w1"), F.col("b").alias("w"), F.col("n").alias("n_2"), F.col("once").alias("once_2")), ["w1", "w"], "left").join(singles, "w", "left")
    d = d.withColumn("by_two", due("n_2", "once_2")).withColumn("by_one", due("n_1", "once_1")).filter("by_two OR by_one")
    usual = tri.filter("ends - 1 > n").select(F.col("a").alias("w2"), F.col("b").alias("w1"), F.col("c").alias("w"))
    d = d.join(usual, ["w2", "w1", "w"], "left_anti").select("hocr_id", "page_idx", "w1", "w", "by_two", "by_one", F.explode("starts").alias("n1"))
    d = d.join(known, "n1", "left")
    d = d.join(inside.select(F.col("a").alias("w1"), F.col("b").alias("w"), F.col("c").alias("n1"), F.col("n").alias("tri_n")), ["w1", "w", "n1"], "left")
    d = d.join(pairs.select(F.col("a").alias("w"), F.col("b").alias("n1"), F.col("n").alias("pair_n")), ["w", "n1"], "left")
    odd = F.col("k_n1").isNull() & F.col("n1").rlike(r"\p{L}")
    per_page = d.groupBy("hocr_id", "page_idx", "by_two", "by_one").agg(F.count("tri_n").alias("threes"), F.count("pair_n").alias("twos"), F.count("k_n1").alias("words"), F.count_if(odd).alias("odd"))
    return per_page.filter("odd = 0 AND words > 0 AND threes = 0 AND (by_two OR (by_one AND twos = 0))").select("hocr_id", "page_idx")


def continuations(tri: DataFrame, asked: DataFrame) -> DataFrame:
    """asked (ctx, w) with ``own``, how often w stands inside lines in its context, and ``longer``, how often a longer word with its letters does.

    A context is two words before, one, or none (see ``contexts``). Only contexts asked for are looked at,
    and each asked word meets one row of sums: no pair of pages or words is formed.
    """
    inside = tri.filter("n > 0")
    two = inside.select(F.concat_ws(AND, "a", "b").alias("ctx"), "c", "n")
    one = inside.groupBy(F.concat(F.lit(AND), "b").alias("ctx"), "c").agg(F.sum("n").alias("n"))
    none = one.groupBy("c").agg(F.sum("n").alias("n")).select(F.lit("").alias("ctx"), "c", "n")
    every = two.unionByName(one).join(asked.filter("ctx <> ''").select("ctx").distinct(), "ctx", "left_semi").unionByName(none)
    parts = F.transform(F.sequence(F.lit(1), F.greatest(F.length("c"), F.lit(1))), lambda k: F.substring("c", F.lit(1), k))
    sums = every.filter(F.length("c") > 0).select("ctx", "c", "n", F.explode(parts).alias("w")).groupBy("ctx", "w").agg(F.sum(F.when(F.col("c") == F.col("w"), F.col("n")).otherwise(0)).alias("own"), F.sum(F.when(F.col("c") != F.col("w"), F.col("n")).otherwise(0)).alias("longer"))
    return asked.join(sums, ["ctx", "w"], "left").na.fill(0, ["own", "longer"])


def contexts() -> dict[str, Column]:
    """The contexts of a page's last word (w2, w1, w), from the nearest."""
    return {"3": F.concat_ws(AND, F.coalesce("w2", F.lit("")), F.coalesce("w1", F.lit(""))), "2": F.concat(F.lit(AND), F.coalesce("w1", F.lit(""))), "1": F.lit("")}


def word_evidence(pages: DataFrame, tri: DataFrame) -> DataFrame:
    """Pages (hocr_id, page_idx, w2, w1, w, n1) with own_K and longer_K for K of 3, 2, 1 words, and whether ``n1`` and ``joined`` are known."""
    roles = [F.struct(F.lit(k).alias("role"), c.alias("ctx"), F.col("w").alias("w")) for k, c in contexts().items()]
    roles += [F.struct(F.lit(c).alias("role"), F.lit("").alias("ctx"), F.col(c).alias("w")) for c in ("joined", "n1")]
    each = pages.select("hocr_id", "page_idx", F.explode(F.array(*roles)).alias("r")).select("hocr_id", "page_idx", "r.*").filter(F.length("w") > 0)
    found = continuations(tri, each.select("ctx", "w").distinct())
    got = each.join(found, ["ctx", "w"])
    pick = lambda role, c: F.coalesce(F.max(F.when(F.col("role") == role, F.col(c))), F.lit(0))
    return got.groupBy("hocr_id", "page_idx").agg(*(pick(k, c).alias(f"{c}_{k}") for k in "321" for c in ("own", "longer")), (pick("joined", "own") >= KNOWN_FROM).alias("k_joined"), (pick("n1", "own") >= KNOWN_FROM).alias("k_n1"))


def goes_over(ends: DataFrame, tri: DataFrame) -> DataFrame:
    """(hocr_id, page_idx) of pages (hocr_id, page_idx, w2, w1, w, own, starts) whose known last word goes on over the seam.

    A trigram inside goes over it with the word or with what the next page makes of it, or the word has
    its place inside and a pair goes over.
    """
    inside = tri.filter("n > 0")
    d = ends.select("hocr_id", "page_idx", "w2", "w1", "w", "own", F.explode("starts").alias("n1"))
    over = inside.select(F.col("a").alias("w1"), F.col("b").alias("w"), F.col("c").alias("n1"), F.lit(1).alias("goes_on"))
    made = inside.select(F.col("a").alias("w2"), F.col("b").alias("w1"), F.col("c").alias("whole"), F.lit(1).alias("made"))
    pairs = inside.select(F.col("a").alias("w"), F.col("b").alias("n1")).distinct().withColumn("pair", F.lit(1))
    d = d.join(over, ["w1", "w", "n1"], "left").join(pairs, ["w", "n1"], "left").withColumn("whole", F.concat("w", "n1")).join(made, ["w2", "w1", "whole"], "left")
    complete = F.col("goes_on").isNotNull() | F.col("made").isNotNull() | ((F.col("own") > 0) & F.col("pair").isNotNull())
    return d.filter(complete).select("hocr_id", "page_idx").distinct()


def field_limits(ends: DataFrame) -> DataFrame:
    """(ocr_system, measure, size): lengths at which a source's pages mostly stop by their markup."""
    sizes = ends.select("ocr_system", "is_cut", F.explode(F.map_from_arrays(F.array(F.lit("chars"), F.lit("bytes")), F.array("chars", "bytes"))).alias("measure", "size"))
    counted = sizes.groupBy("ocr_system", "measure", "size").agg(F.count("*").alias("n"), F.avg(F.col("is_cut").cast("double")).alias("stopped"))
    found = counted.filter((F.col("n") >= LIMIT_FROM) & (F.col("stopped") >= 0.5))
    # pages cut at one number of characters spread over some numbers of bytes, and the other way round:
    # the lengths that most pages share are the limits, the spread is none
    most = found.groupBy(F.col("ocr_system").alias("_s")).agg(F.max("n").alias("most"))
    real = found.join(most, F.col("ocr_system").eqNullSafe(F.col("_s"))).filter(F.col("n") >= 0.5 * F.col("most"))
    return real.groupBy("ocr_system", "size").agg(F.max_by("measure", F.struct("n", "measure")).alias("measure"))


def with_next_start(ends: DataFrame) -> DataFrame:
    """Each page's end with the start of the volume's next page, ordered in parts so that no volume is one task."""
    part = F.floor(F.col("hocr_id") / FILES_PER_PART)
    w = Window.partitionBy("volume_id", "part").orderBy("hocr_id", "page_idx")
    head = F.struct("start", "starts", "starts_heading")
    d = ends.withColumn("part", part).withColumn("head", head).withColumn("after", F.lead("head").over(w)).withColumn("_r", F.row_number().over(w))
    heads = d.filter("_r = 1").select(F.col("volume_id").alias("_v"), F.col("part").alias("_p"), F.lead("head").over(Window.partitionBy("volume_id").orderBy("part")).alias("next_part"))
    d = d.join(heads, d["volume_id"].eqNullSafe(F.col("_v")) & (d["part"] == F.col("_p")), "left")
    return d.withColumn("after", F.coalesce("after", "next_part")).withColumn("next", F.col("after.start")).withColumn("next_starts", F.col("after.starts")).withColumn("next_heading", F.coalesce("after.starts_heading", F.lit(False))).drop("part", "head", "after", "_r", "_v", "_p", "next_part")


def judged_pages(hocr: DataFrame) -> DataFrame:
    """(hocr_id, page_idx, ocr_system, truncated, reason) of every non-empty page of the current files.

    Null and empty pages are none; a file of null id or source counts like any other; files delivered
    again count once. Counts of trigrams and lengths are taken over all pages. Reasons, the first that
    holds: ``tag`` (within a tag), ``markup`` (before its elements are closed), ``word`` (within a word),
    ``repair`` (closed by a repair), ``limit``, ``sentence`` (between two words).
    """
    pages = kept(page_texts(hocr))  # a tenth of the markup; ends and trigrams are both made from it
    ends = kept(with_next_start(only_current(with_ends(pages), hocr, "hocr_id").dropDuplicates(["hocr_id", "page_idx"]).drop("loaded_at")))
    tri = kept(inner_trigrams(pages))
    final = kept(markup_verdicts(kept(markup_trigrams(pages))).select("x", "y", "z", "is_cut"))

    d = ends.join(final, ["x", "y", "z"], "left").na.fill(False, ["is_cut"])
    d = d.withColumn("last", F.regexp_replace(F.coalesce("last", F.lit("")), END_MARKS, "")).withColumn("w", norm("last")).withColumn("n1", F.coalesce(norm("next"), F.lit("")))
    d = d.withColumn("joined", F.concat("w", "n1"))
    wordlike = F.col("last").rlike(r"[\p{L}\p{M}]$") & ~F.col("w").rlike(r"\p{N}")
    closed = d.filter(~F.col("is_cut") & (F.col("ends_with") != "pageno") & wordlike).select("hocr_id", "page_idx", "w2", "w1", "w", "n1", "joined", "next_starts", "ends_with")
    seen = kept(_by_page(closed, word_evidence(closed, tri)).na.fill(0, [f"{c}_{k}" for k in "321" for c in ("own", "longer")]).na.fill(False, ["k_joined", "k_n1"]))
    whole = F.col("k_joined") & (F.col("ends_with") == "body")
    known = (F.col("own_1") >= KNOWN_FROM) & (F.col("own_1") > NOISE_SHARE * F.col("longer_1"))
    share = lambda k: (F.col(f"own_{k}") + 1) / (F.col(f"own_{k}") + F.col(f"longer_{k}") + 1) <= FRAGMENT_SHARE
    nearer = lambda k: (F.col(f"longer_{k}") > 0) & (F.col(f"own_{k}") == 0) | share(k)
    part = seen.filter(~known & ~whole & (nearer("3") | nearer("2") | share("1"))).select("hocr_id", "page_idx")
    doubtful = seen.filter(known & ~whole & share("3")).select("hocr_id", "page_idx", "w2", "w1", "w", F.col("own_3").alias("own"), F.col("next_starts").alias("starts"))
    part = part.unionByName(doubtful.select("hocr_id", "page_idx").exceptAll(goes_over(doubtful, tri))).withColumn("cut_word", F.lit(True))
    seam = seen.filter((F.col("ends_with") == "body") & known)
    broken = broken_seams(seam.select("hocr_id", "page_idx", "w2", "w1", "w", F.col("next_starts").alias("starts")), tri).withColumn("cut_sentence", F.lit(True))

    d = kept(_by_page(_by_page(d.select("hocr_id", "page_idx", "ocr_system", "x", "y", "z", "chars", "bytes", "is_cut"), part), broken).na.fill(False, ["cut_word", "cut_sentence"]))
    repairs = d.filter(~F.col("is_cut")).groupBy("x", "y", "z").agg(F.count("*").alias("n"), F.avg(F.col("cut_word").cast("double")).alias("parts")).filter((F.col("n") >= LIMIT_FROM) & (F.col("parts") >= 0.5))
    d = d.join(repairs.select("x", "y", "z", F.lit(True).alias("repair")), ["x", "y", "z"], "left").na.fill(False, ["repair"])
    limits = field_limits(d)
    for m in ("chars", "bytes"):
        of = limits.filter(F.col("measure") == m).select(F.col("ocr_system").alias("_s"), F.col("size").alias("_n"), F.lit(True).alias(f"at_{m}"))
        d = d.join(of, d["ocr_system"].eqNullSafe(F.col("_s")) & (d[m] == F.col("_n")), "left").drop("_s", "_n")
    limit = F.coalesce("at_chars", "at_bytes", F.lit(False))
    reason = F.when(F.col("is_cut") & F.col("z").startswith(UNFINISHED), "tag").when(F.col("is_cut"), "markup").when(F.col("cut_word"), "word").when(F.col("repair"), "repair").when(limit, "limit").when(F.col("cut_sentence"), "sentence")
    return d.select("hocr_id", "page_idx", "ocr_system", reason.isNotNull().alias("truncated"), reason.alias("reason"))


def _by_page(d: DataFrame, marks: DataFrame) -> DataFrame:
    marks = marks.withColumnRenamed("hocr_id", "_h").withColumnRenamed("page_idx", "_i")
    return d.join(marks, d["hocr_id"].eqNullSafe(F.col("_h")) & (d["page_idx"] == F.col("_i")), "left").drop("_h", "_i")


def truncation_shares(hocr: DataFrame) -> DataFrame:
    """(ocr_system, n_pages, n_truncated, share): how often each source truncates."""
    return judged_pages(hocr).groupBy("ocr_system").agg(F.count("*").alias("n_pages"), F.sum(F.col("truncated").cast("long")).alias("n_truncated"), F.avg(F.col("truncated").cast("double")).alias("share"))
