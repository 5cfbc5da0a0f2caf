"""Visually identical text with different characters: one consistent form for every word.

Method: the confusables skeleton. A word is decomposed, every character replaced by its prototype from a
look-alike table, and decomposed again: widths, presentation forms, invisible characters and the script of
look-alike letters are gone. Originals of equal skeleton form a group; the script in which the group's
words are written is that of its members whose letters tell it, of the one that the lexicon knows, or of
the one far more frequent. The consistent form is the skeleton written in that script with precomposed
letters; a stored word that differs from it is not consistent.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.session import kept
from foliant.sources.tables import only_current

# Letters that look like a Latin letter, as pairs, by script.
LOOKALIKES = {
    "CYRILLIC": "аa еe оo рp сc уy хx іi ѕs јj һh ԁd ԛq ԝw ӏl АA ВB ЕE КK МM НH ОO РP СC ТT УY ХX ІI ЅS ЈJ ԚQ ԜW",
    "GREEK": "οo νv αa ιi ρp υu κk χx ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX",
    "ARMENIAN": "օo սu հh ոn զq ցg յj ՕO ՍU ՏS ԼL",
    "CHEROKEE": "ᎠD ᎡR ᎢT ᎥI ᎪA ᎫJ ᎬE ᎳW ᎷM ᎻH ᎽY ᏀG ᏃZ ᏎV ᏔW ᏚS ᏞL ᏟC ᏢP ᏦK ᏴB",
    "COPTIC": "ⲟo ⲥc ⲣp ⲞO ⲤC ⲢP ⲎH ⲒI ⲔK ⲘM ⲚN ⲦT ⲬX",
}
PROTOTYPE = {pair[0]: pair[1] for pairs in LOOKALIKES.values() for pair in pairs.split()}
#: By script: a prototype's letter there.
LETTER_OF = {script: {pair[1]: pair[0] for pair in reversed(pairs.split())} for script, pairs in LOOKALIKES.items()} | {"LATIN": {}}
#: Latin letters that alone do not tell Latin from Cyrillic or Greek.
ASCII_TWINS = frozenset(LETTER_OF["CYRILLIC"]) | frozenset(LETTER_OF["GREEK"])

#: How many times more frequent a group's other script must be where the lexicon knows neither.
FAR_MORE = 5
#: Runs of letters and their marks; in a word without markup also over single stray marks of the scan.
LETTERS = r"(?:[^\W\d_][̀-ͯ҃-ً҇-ٰٟ]*)+"
RUN = re.compile(LETTERS)
RUN_OVER_STRAYS = re.compile(LETTERS + r"(?:['^~;.,|`·]" + LETTERS + ")*")
MARKUP = re.compile(r"[\\<>{}()\[\]&#/*_=]|''")
#: What may need a look outside plain ASCII: Java syntax, for the filter before any Python.
MAYBE = r"[^\x00-\x7F]|^[^A-Za-z]*[aceopxysijhdqwlvukABEKMHOPCTYXISJQWZN]+[^A-Za-z]*$"


@lru_cache(maxsize=100_000)
def script_of(ch: str) -> str:
    """The script in a letter's Unicode name; other scripts than the confusable ones by the same rule."""
    name = unicodedata.name(ch, "")
    return name.split(" ", 1)[0] if name else ""


def invisible(ch: str) -> bool:
    """Format characters, fillers and variation selectors that print nothing."""
    return unicodedata.category(ch) == "Cf" or ch in "͏ᅟᅠㅤﾠ" or "︀" <= ch <= "️" or "\U000e0000" <= ch <= "\U000e0fff"


# Spaces other than the plain one, and the kinds of compatible characters that print as others do.
SPECIAL_SPACES = frozenset("\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
SAME_PRINT = frozenset("wide narrow small isolated initial medial final font vertical".split())


@lru_cache(maxsize=100_000)
def decomposed(ch: str) -> str:
    """A character's parts: nothing for invisible ones, a plain space for special ones, ordinary letters for widths and presentation forms."""
    if invisible(ch):
        return ""
    if ch in SPECIAL_SPACES:
        return " "
    how = unicodedata.decomposition(ch)
    tag = how[1 : how.index(">")] if how.startswith("<") else ""
    if tag in SAME_PRINT or tag == "compat" and 0xFB00 <= ord(ch) <= 0xFB4F:
        return unicodedata.normalize("NFKD", ch)
    return unicodedata.normalize("NFD", ch)


def plain(word: str) -> str:
    """Decomposed and put together again, each letter in its own script."""
    if word.isascii():
        return word
    made = unicodedata.normalize("NFC", "".join(map(decomposed, word)))
    return made.strip(" ") if any(c in SPECIAL_SPACES for c in word) else made


def skeleton(word: str) -> str:
    """Decompose, replace by prototypes, decompose again."""
    parts = (PROTOTYPE.get(c, c) for ch in word for c in decomposed(ch))
    return unicodedata.normalize("NFD", "".join(parts))


def written(bones: str, script: str) -> str:
    """A skeleton in the letters of a script, precomposed."""
    letters = LETTER_OF.get(script, {})
    return unicodedata.normalize("NFC", "".join(letters.get(c, c) for c in bones))


def scripts(run: str) -> set[str]:
    return {script_of(ch) for ch in run if ch.isalpha() and script_of(ch) != "MODIFIER"}


def settled_script(run: str) -> str | None:
    """The script that tells itself by letters without a look-alike in the run's other scripts; none where none or several do."""
    own = set()
    kinds = scripts(run)
    for ch in unicodedata.normalize("NFD", run):
        if not ch.isalpha() or script_of(ch) == "MODIFIER":
            continue
        kind = script_of(ch)
        others = (kinds - {kind}) or ({"CYRILLIC", "GREEK"} if kind == "LATIN" else {"LATIN"})
        base = PROTOTYPE.get(ch, ch)
        twin = (kind == "LATIN" or base != ch) and any(base in LETTER_OF[o] if o != "LATIN" else base != ch for o in others if o in LETTER_OF)
        if not twin:
            own.add(kind)
    return own.pop() if len(own) == 1 else None


def majority_script(run: str) -> str:
    kinds = [script_of(ch) for ch in run if ch.isalpha()]
    return max(sorted(set(kinds)), key=kinds.count)


def runs_in(word: str) -> re.Pattern:
    return RUN if MARKUP.search(word) else RUN_OVER_STRAYS


def open_run(run: str) -> bool:
    """Whether all letters of a run have look-alikes, so that it may be a word of another script."""
    return settled_script(run) is None and all(c in PROTOTYPE or any(c in t for t in LETTER_OF.values()) or not c.isalpha() for c in unicodedata.normalize("NFD", run)) and bool(scripts(run) & LETTER_OF.keys())


def runs_of(word: str) -> list[tuple[str, str, str, bool]]:
    """(run, skeleton, script, is_open) of the letters of a word, as far as they tell their script."""
    if word.isascii():  # its own skeleton
        return [(m[0], m[0], "LATIN", all(c in ASCII_TWINS for c in m[0] if c.isalpha())) for m in runs_in(word).finditer(word)]
    out = []
    for m in runs_in(word := plain(word)).finditer(word):
        kinds = scripts(m[0])
        if kinds:
            out.append((m[0], skeleton(m[0]), (settled_script(m[0]) if len(kinds) > 1 else None) or majority_script(m[0]), open_run(m[0])))
    return out


def consistent(word: str, decided: dict[str, str]) -> str:
    """The word with every run's skeleton written in its script; ``decided`` has that of runs whose group knows better."""
    if word.isascii() and not decided:
        return word
    form = plain(word)
    runs = iter(runs_of(form))

    def fix(m: re.Match) -> str:
        if not scripts(m[0]):
            return m[0]
        run, bones, script, _ = next(runs)
        return written(bones, decided.get(run, script))

    return runs_in(form).sub(fix, form)


def by_letters(word: str) -> tuple[str, list[str]]:
    """The consistent form as far as the letters tell it, and the runs that look alike in other scripts."""
    return consistent(word, {}), [run for run, _, _, is_open in runs_of(word) if is_open]


RUNS = T.ArrayType(T.StructType([T.StructField("run", T.StringType()), T.StructField("skeleton", T.StringType()), T.StructField("script", T.StringType()), T.StructField("is_open", T.BooleanType())]))


@F.pandas_udf(RUNS)
def runs_udf(words: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Runs of distinct words, with the skeletons by which they are grouped (of the word in lower case)."""
    for s in words:
        yield pd.Series([[(r, skeleton(r.casefold()).casefold(), script, is_open) for r, _, script, is_open in runs_of(w)] for w in s], dtype=object)


@F.pandas_udf(T.StringType())
def consistent_udf(words: pd.Series, decided: pd.Series) -> pd.Series:
    """Consistent forms, with the scripts that groups decided (run, script)."""
    return pd.Series([consistent(w, {r["run"]: r["script"] for r in (todo if todo is not None else [])}) for w, todo in zip(words, decided, strict=True)])


def consistent_forms(words: DataFrame, lexicon: DataFrame | None = None) -> DataFrame:
    """(word, n, form): distinct stored words that are not in the consistent form, and that form.

    ``words`` has a column ``word``. Null and empty words have no form and are left out. The lexicon
    (word) settles runs whose letters all have look-alikes; without it the far more frequent member of
    the skeleton's group does. Words count over all rows; a frequent word is combined before the shuffle.
    """
    forms = words.filter(F.col("word").rlike(MAYBE)).groupBy("word").agg(F.count("*").alias("n"))
    read = kept(forms.withColumn("runs", runs_udf("word")))  # each form is read once
    runs = read.select("word", "n", F.explode("runs").alias("r")).select("word", "n", "r.*")
    member = runs.groupBy("skeleton", "script").agg(F.sum("n").alias("n"))
    if lexicon is not None:
        entries = lexicon.filter(F.length("word") > 0).withColumn("r", F.explode(runs_udf("word"))).filter(F.col("r.run") == F.col("word"))
        member = member.join(entries.select("r.skeleton", "r.script", F.lit(1).alias("known")).distinct(), ["skeleton", "script"], "full")
    else:
        member = member.withColumn("known", F.lit(None).cast("int"))
    rank = F.struct(F.coalesce("known", F.lit(0)).alias("known"), F.coalesce("n", F.lit(0)).alias("n"), F.col("script").alias("script"))
    best = member.groupBy("skeleton").agg(F.max(rank).alias("best"))
    counts = member.select("skeleton", "script", F.coalesce("known", F.lit(0)).alias("own_known"), F.coalesce("n", F.lit(0)).alias("own_n"))
    decided = (
        runs.filter("is_open")
        .join(counts, ["skeleton", "script"], "left")
        .join(best, "skeleton", "left")
        .filter((F.col("best.script") != F.col("script")) & ((F.col("best.known") > F.col("own_known")) | ((F.col("best.known") == F.col("own_known")) & (F.col("best.n") >= FAR_MORE * F.col("own_n")))))
        .groupBy("word")
        .agg(F.collect_set(F.struct("run", F.col("best.script").alias("script"))).alias("todo"))
    )
    full = read.join(decided, "word", "left").withColumn("form", consistent_udf("word", F.coalesce("todo", F.array().cast("array<struct<run:string,script:string>>"))))
    return full.filter(F.col("word") != F.col("form")).select("word", "n", "form")


def inconsistent_words(sources: dict[str, tuple[DataFrame, str, str]], lexicon: DataFrame | None = None) -> DataFrame:
    """(table_name, row_id, word, form) of current rows whose word is not in the consistent form.

    sources: name to (table, key, word column). Counts for the groups are taken over all tables.
    """
    rows = None
    for name, (df, key, column) in sources.items():
        part = df.select(F.lit(name).alias("table_name"), F.col(key).cast("long").alias("row_id"), F.col(column).alias("word"), "loaded_at").filter(F.col("word").rlike(MAYBE))
        rows = part if rows is None else rows.unionByName(part)
    wrong = kept(consistent_forms(rows.select("word"), lexicon))
    found = rows.join(wrong.select("word", "form"), "word")
    out = None
    for name, (df, key, _) in sources.items():
        part = only_current(found.filter(F.col("table_name") == name), df.select(F.col(key).cast("long").alias("row_id"), "loaded_at"), "row_id")
        part = part.select("table_name", "row_id", "word", "form").dropDuplicates(["row_id"])
        out = part if out is None else out.unionByName(part)
    return out
