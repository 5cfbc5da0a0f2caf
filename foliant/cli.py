"""Command line: python -m foliant.cli {batch,report,audit,extract,proofread,recognise,split} ...

Folders are read as rows of files and results written back as files, as the workflow's steps pass them on.
Steps that need a service or codec take ``--client module:factory`` (see ``foliant.sources.remote``).
"""

from __future__ import annotations

import argparse
import datetime as dt
import fnmatch
import importlib
import json
import logging
import shutil
import sys
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions import text as tx
from foliant.operators import audit, batching, diff, hocr, profile, quota, render, retry, roles
from foliant.session import discard_kept, kept, local_session
from foliant.sources import files, remote

EXIT_COUNT_MISMATCH, EXIT_NO_INPUT = 2, 1
log = logging.getLogger("foliant")


def percent(s: str) -> int:
    n = int(s)
    if not 1 <= n <= 49:
        raise argparse.ArgumentTypeError("1 to 49 percent")
    return n


def temperature(s: str) -> float:
    t = float(s)
    if not 0 <= t <= 1:
        raise argparse.ArgumentTypeError("a temperature is between 0 and 1")
    return t


def positive(s: str) -> int:
    n = int(s)
    if n < 1:
        raise argparse.ArgumentTypeError("at least 1")
    return n


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="foliant", description=__doc__)
    p.add_argument("-v", "--verbose", action="store_true")
    p.add_argument("-l", "--log-to-file", nargs="?", const=".", metavar="DIR", help="keep a log of this run in DIR")
    sub = p.add_subparsers(dest="step", required=True)
    b = sub.add_parser("batch", help="cut a book's hOCR and images into batch folders")
    b.add_argument("-f", "--hocr", required=True)
    b.add_argument("-i", "--images-dir", required=True)
    b.add_argument("-o", "--output-dir", required=True)
    b.add_argument("-b", "--batch-size", type=positive, default=20)
    r = sub.add_parser("report", help="differences, merged hOCR and documents of all batches")
    r.add_argument("-i", "--input", required=True)
    r.add_argument("-s", "--source")
    r.add_argument("-o", "--output", required=True)
    r.add_argument("--keep-lone", action="store_true", help="take pages of batches without an original into the documents")
    for flag in ("--latex", "--latex-page-breaks", "--markdown", "--markdown-preserve-formatting"):
        r.add_argument(flag, action="store_true")
    a = sub.add_parser("audit", help="batches without a plausible corrected file")
    a.add_argument("dir")
    a.add_argument("-s", "--size-percent", type=percent, default=10)
    a.add_argument("-p", "--pattern", default="*-proofread.hocr")
    a.add_argument("-v", "--verbose", action="store_true")
    for name, default in (("extract", None), ("proofread", None)):
        x = sub.add_parser(name, help="ask a language model about page images")
        x.add_argument("path")
        x.add_argument("-o", "--output")
        x.add_argument("-p", "--prompt", default="")
        x.add_argument("-t", "--temperature", type=temperature, default=0.0)
        x.add_argument("-m", "--max-attempts", type=positive, default=1)
        x.add_argument("--client", required=True, default=default)
        x.add_argument("--model", default="", help="the client's model, whose quotas hold")
        x.add_argument("--quota-config", help="JSON with the quotas of models; without it none hold")
        x.add_argument("--clock", default="foliant.cli:clock", help="module:factory of (now, sleep), in seconds")
        x.add_argument("--first", type=positive)
        x.add_argument("--last", type=positive)
        if name == "extract":
            x.add_argument("-s", "--chunk-size", type=positive, default=30)
    o = sub.add_parser("recognise", help="Markdown, hOCR and word CSV from a recognition service")
    o.add_argument("-p", "--pattern", required=True)
    o.add_argument("-o", "--output", default=".")
    o.add_argument("--print-page-dimensions", action="store_true")
    o.add_argument("--client", required=True)
    s = sub.add_parser("split", help="where to split two-page scans, as crop commands")
    s.add_argument("dir")
    s.add_argument("-o", "--output", required=True)
    s.add_argument("--shadow-threshold", type=float, default=50.0)
    s.add_argument("--client", required=True)
    return p


def clock() -> tuple[Callable[[], float], Callable[[float], None]]:
    """The time and how to wait."""
    return time.time, time.sleep


def client(name: str):
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


def batch(spark: SparkSession, o: argparse.Namespace) -> int:
    """Batches of a book: images and the hOCR of their pages; images and pages must be equally many."""
    found = files.texts(spark, o.hocr).select(hocr.structure(F.col("text")).alias("s")).select("s.*")
    pages = found.select("prefix", "body_open_tag", "status", F.posexplode_outer("pages").alias("page_idx", "page"))
    images = files.images(spark, o.images_dir, "batch").select("name").orderBy("name")
    n_pages, n_images = pages.filter("page IS NOT NULL").count(), images.count()
    if n_pages != n_images or not n_pages:
        print(f"{n_images} images and {n_pages} pages", file=sys.stderr)
        return EXIT_COUNT_MISMATCH
    one = F.lit(1).alias("g")
    both = batching.zipped(images.select(one, "name"), pages.select(one, "page_idx", "page", "prefix", "body_open_tag"), ["g"], ["name"], ["page_idx"])
    both = both.withColumn("batch", batching.batch_of(F.col("position"), o.batch_size)).withColumn("page", hocr.with_page_comment(F.col("page"), F.col("position"), F.col("name")))
    made = both.groupBy("batch").agg(F.min("position").alias("a"), F.max("position").alias("b"), F.max("prefix").alias("prefix"), F.max("body_open_tag").alias("tag"), F.transform(F.array_sort(F.collect_list(F.struct("position", "page"))), lambda x: x["page"]).alias("pages"), F.array_sort(F.collect_list("name")).alias("names"))
    name = tx.batch_file(F.lit(Path(o.hocr).name), F.col("a"), F.col("b"))
    made = made.select(F.concat_ws("/", tx.batch_folder(F.col("a"), F.col("b")), name).alias("file"), hocr.assembled(F.col("prefix"), F.col("tag"), F.col("pages")).alias("text"), "names")
    files.export_texts(made, o.output_dir, "file", "text")
    for r in made.select("file", "names").toLocalIterator():  # one row a batch, for copying its images
        for n in r.names:
            shutil.copy2(Path(o.images_dir) / n, Path(o.output_dir) / Path(r.file).parent / n)
    return 0


def hocr_files(spark: SparkSession, folder: str) -> DataFrame:
    """dir, name, mtime, text of the hOCR files in a folder's subfolders."""
    listed = files.listing(spark, folder, pattern="*.hocr")
    texts = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.hocr").load(folder).select("path", F.decode("content", "UTF-8").alias("text"))
    return listed.join(texts, "path")


def report(spark: SparkSession, o: argparse.Namespace) -> int:
    f = hocr_files(spark, o.input)
    r = roles.resolved(f, ["dir"], "name", "mtime")
    if not r.take(1):
        print("no batches", file=sys.stderr)
        return EXIT_NO_INPUT
    text = f.select("dir", F.col("name").alias("proofread"), "text")
    before = f.select("dir", F.col("name").alias("original"), F.col("text").alias("before"))
    pairs = r.join(text, ["dir", "proofread"]).join(before, ["dir", "original"], "left")
    lines = kept(diff.line_differences(pairs.filter("original IS NOT NULL").select(F.col("dir").alias("batch_dir"), F.col("proofread").alias("file"), "before", "text"), ["batch_dir", "file"], "before", "text"))
    out = Path(o.output)
    parts = diff.batch_report(lines, [], "batch_dir", "file").withColumn("name", F.concat_ws("/", F.lit("diffs"), F.concat("batch_dir", F.lit(".diff"))))
    files.export_texts(parts, str(out), "name", "text")
    base = r.orderBy("dir").select(roles.base_name(F.lit(Path(o.source).name if o.source else None).cast("string"), F.col("proofread"), F.col("dir"))).first()[0]
    files.write_document(parts, str(out / f"{base}.diff"), ["batch_dir"], "text", by="\n")
    head, tail = diff.report_frame(base)
    files.write_document(diff.report_rows(lines, "batch_dir", "file"), str(out / f"{base}-diff.html"), ["batch_dir", "ord"], "html", head, tail, "\n")
    # a batch with one file only has nothing to be compared with, and its pages are left out, as the workflow has it
    whole = pairs if o.keep_lone else pairs.filter("original IS NOT NULL")
    parsed = whole.select("dir", hocr.structure(F.col("text")).alias("s"))
    merged = render.merged_parts(parsed.select(F.lit(0).alias("g"), F.col("dir").alias("batch_dir"), F.col("s.prefix").alias("prefix"), F.col("s.pages").alias("pages")), "g").withColumn("ends", F.col("batch_dir").isNull())
    files.write_document(merged, str(out / f"{base}-merged.hocr"), ["ends", "batch_dir", "part"], "text")
    if o.latex or o.markdown:
        order = parsed.select("dir", F.posexplode("s.pages").alias("i", "html"))
        numbered = batching.numbered(order.withColumn("hocr_id", F.lit(0)), ["hocr_id"], ["dir", "i"], "page_idx")
        tag = F.regexp_extract("html", r"(?i)<div\b[^>]*>", 0)
        pages = numbered.select("hocr_id", "page_idx", tx.box_of(tag).alias("page_box"), tx.page_number(tag).alias("page_num"), tx.image_name(F.col("html")).alias("image"))
        page_lines = hocr.lines(numbered, ["hocr_id", "page_idx"], "html")
        words = hocr.words(page_lines, ["hocr_id", "page_idx"])
        args = (page_lines.drop("words"), words, pages)
        if o.markdown:
            files.write_document(render.markdown_pages(*args, preserve=o.markdown_preserve_formatting), str(out / f"{base}.md"), ["page_idx"], "text", by="\n\n")
        if o.latex:
            head, between, tail = render.latex_frame(o.latex_page_breaks)
            files.write_document(render.latex_pages(*args), str(out / f"{base}.tex"), ["page_idx"], "text", head, tail, between)
    return 0


def audit_folder(spark: SparkSession, o: argparse.Namespace) -> int:
    pattern = fnmatch.translate(o.pattern).replace("(?s:", "(?:").replace(")\\Z", ")$").replace(")\\z", ")$")
    held = audit.audited(files.listing(spark, o.dir), "dir", "name", "size", o.size_percent, pattern)
    folders = set(files.subfolders(spark, o.dir))
    seen = set()
    for r in held.orderBy("folder", "name").toLocalIterator():
        if r.folder in folders:
            seen.add(r.folder)
            if r.status != "ok" or o.verbose:
                print(f"{r.folder}: {r.name or 'no matching file'} {r.status}")
    for name in sorted(folders - seen):
        print(f"{name}: no matching file missing")
    return 0


def turnstile(rows: list[tuple], clock_name: str) -> quota.Turnstile:
    return quota.Turnstile(rows, *client(clock_name)())


def extract(spark: SparkSession, o: argparse.Namespace) -> int:
    """One text of all images, asked for in chunks: one after the other, as their model's quotas count them."""
    make = client(o.client)
    images = files.images(spark, o.path).select(F.lit(0).alias("g"), "path", "name")
    if o.first or o.last:
        images = batching.selected_range(images, ["g"], ["name"], o.first or 1, o.last)
    chunks = batching.numbered(images.drop("position"), ["g"], ["name"]).withColumn("chunk", batching.batch_of(F.col("position"), o.chunk_size))
    asked = chunks.groupBy("chunk").agg(F.array_sort(F.collect_list("path")).alias("images")).withColumn("prompt", F.lit(o.prompt))
    rows, clock_name = _quotas(spark, o), o.clock

    def factory():
        model, gate = make(), turnstile(rows, clock_name)

        def one(prompt, images):
            refused = gate.enter()
            if refused != "ok":
                raise RuntimeError(f"quota exceeded: {refused}")
            text = model(prompt, images)
            gate.went_through()
            return text

        return one

    got = kept(remote.answers(asked.coalesce(1), ["chunk"], ["prompt", "images"], factory))  # asked once
    failed = got.filter("status <> 'ok'").orderBy("chunk").take(1)
    if failed:  # one failed request ends the run
        print(f"request failed: {failed[0].status} {failed[0].error}", file=sys.stderr)
        return EXIT_NO_INPUT
    folder = Path(o.output or (o.path if Path(o.path).is_dir() else Path(o.path).parent))
    names = spark.range(1).select(*(tx.answer_name(F.lit(_minute()), k).alias(k) for k in ("output", "prompt"))).first()
    files.write_document(got, str(folder / names.output), ["chunk"], "text", by="\n\n")
    (folder / names.prompt).write_text(o.prompt, "utf-8")
    return 0


def _minute() -> dt.datetime:
    return dt.datetime.now().replace(second=0, microsecond=0)


def _quotas(spark: SparkSession, o: argparse.Namespace) -> list[tuple]:
    """The model's quotas; a warning where there are none, since its calls are not counted then."""
    found = files.quota_config(spark, o.quota_config).filter(F.col("model") == o.model).drop("model").collect() if o.quota_config else []  # a few rows of one model
    if not found:
        log.warning("no quotas for model %r: its calls are not counted", o.model)
    return [tuple(r) for r in found]


def proofread(spark: SparkSession, o: argparse.Namespace) -> int:
    """Correct each folder's hOCR against its image; results and what failed lie beside the input.

    Calls go one after the other: their quotas and the minute between pages are their model's.
    """
    make = client(o.client)
    pairs = files.single_pairs(files.listing(spark, o.path))
    texts = hocr_files(spark, o.path).select("dir", F.col("name").alias("hocr"), "text")
    saved = files.texts(spark, o.path, "*-proofread.lasttemp").select(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("dir"), files.last_temperature(F.col("text")).alias("saved"))
    start = F.when(F.col("saved") == 0, retry.STEP).otherwise(F.coalesce("saved", F.lit(o.temperature)))
    work = pairs.join(texts, ["dir", "hocr"]).join(saved, "dir", "left").select("dir", "hocr", "image", tx.proofread_prompt(F.col("text"), "hocr").alias("prompt"), start.alias("start"))
    if o.first or o.last:
        chosen = batching.selected_range(work.select(F.lit(0).alias("g"), "dir"), ["g"], ["dir"], o.first or 1, o.last)
        work = work.join(chosen.select("dir"), "dir")
    attempts, rows, clock_name = o.max_attempts, _quotas(spark, o), o.clock

    def factory():
        model, gate = make(), turnstile(rows, clock_name)

        def corrected(prompt, image, first):
            def one(t):
                refused = gate.enter()
                if refused != "ok":
                    return retry.Outcome("error_quota", 0, text=f"quota exceeded: {refused}")
                began = gate.now()
                try:
                    text = model(prompt, image, t) or ""
                except Exception as e:  # noqa: BLE001
                    return retry.outcome_of(e, gate.to_reset())
                gate.went_through()
                good = text.rstrip().endswith("</html>")
                return retry.Outcome("ok" if good else "no closing </html> tag", elapsed=gate.now() - began, text=text)

            run = retry.correct_page(one, first, attempts, sleep=gate.sleep)
            if run.text is None:  # what the side files of a failed page hold
                raise RuntimeError(json.dumps({"temperature": run.temperatures[-1], "attempts": len(run.statuses), "status": run.statuses[-1], "answer": run.answers[-1]}))
            return run.text

        return corrected

    got = kept(remote.answers(work.coalesce(1).sortWithinPartitions("dir"), ["dir", "hocr"], ["prompt", "image", "start"], factory))  # asked once
    at = lambda name: F.concat_ws("/", "dir", name).alias("name")
    files.export_texts(got.filter("status = 'ok'").select(at(tx.proofread_name(F.col("hocr"))), "text"), o.path, "name", "text")
    now = F.lit(_minute()).cast("timestamp")
    failed = got.filter("status <> 'ok'").select("dir", "hocr", "error", F.from_json("error", "temperature double, attempts int, status string, answer string").alias("e"))
    n = F.coalesce(F.col("e.attempts"), F.lit(1))
    sides = (
        (tx.temperature_file(F.col("hocr")), F.coalesce(F.col("e.temperature").cast("string"), F.lit(""))),
        (tx.failed_file(F.col("hocr"), now, n), F.coalesce("e.answer", F.lit(""))),
        (tx.failed_file(F.col("hocr"), now, n, "err"), F.coalesce("e.status", "error")),
    )
    for name, text in sides:
        files.export_texts(failed.select(at(name), text.alias("text")), o.path, "name", "text")
    return 0


def recognise(spark: SparkSession, o: argparse.Namespace) -> int:
    """Markdown, hOCR and word CSV of all scans in order of their paths, each in one file; pages are numbered through all of them."""
    scans = files.matching(spark, o.pattern)
    if not scans.take(1):
        print(f"no files match {o.pattern}", file=sys.stderr)
        return EXIT_NO_INPUT
    read = kept(remote.recognised(scans.select("path", F.col("name").alias("filename"), "content"), ["path", "filename"], "content", client(o.client)))  # read once
    pages = kept(batching.numbered(read.filter("page_idx IS NOT NULL").withColumn("g", F.lit(0)), ["g"], ["path", "page_idx"], "page_no").drop("g"))
    key = ["path", "page_no"]
    lines = pages.select(*key, F.posexplode("lines").alias("line_idx", "l"))
    box = tx.polygon_box(F.col("l.polygon"))
    top, bottom = F.get("l.polygon", F.lit(1)), F.get("l.polygon", F.lit(7))
    lines = lines.select(*key, "line_idx", F.col("l.content").alias("text"), box.alias("bbox"), top.alias("y"), top.alias("y_top"), bottom.alias("y_bottom"))
    words = pages.select("filename", *key, F.posexplode("words").alias("word_idx", "w"))
    wbox = tx.polygon_box(F.col("w.polygon"))
    words = words.select("filename", *key, "word_idx", F.col("w.content").alias("content"), wbox.alias("bbox"), F.get("w.polygon", F.lit(1)).alias("y"), F.col("w.confidence").alias("confidence"))
    names = spark.range(1).select(*(tx.result_name(F.lit(_minute()), e).alias(e) for e in ("md", "hocr", "csv"))).first()
    out = Path(o.output)

    paragraphs = render.recognised_paragraphs(lines, key).groupBy(*key, "paragraph").agg(render.in_order(F.col("line_idx"), F.col("text"), " ").alias("text"))
    md = render.recognised_markdown(read, pages, paragraphs, o.print_page_dimensions)
    files.write_document(md, str(out / names.md), ["path", "page_no", "part"], "text", "# OCR Results\n\n")
    head, tail = render.RECOGNISED_HEAD, render.RECOGNISED_TAIL
    files.write_document(render.recognised_hocr(pages, lines, words), str(out / names.hocr), key, "text", head, tail)
    row = F.concat(render.word_csv_rows(F.col("filename"), F.coalesce("content", F.lit("")), F.col("confidence"), F.col("bbox.x0"), F.col("bbox.y0")), F.lit("\n"))
    files.write_document(words.filter("bbox IS NOT NULL").select(*key, "word_idx", row.alias("text")), str(out / names.csv), [*key, "word_idx"], "text", "filename,word,confidence,left_x,upper_y\n")
    return 0


def split(spark: SparkSession, o: argparse.Namespace) -> int:
    scans = spark.read.format("binaryFile").load(o.dir).select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "content").filter(tx.is_image(F.col("name"), "split"))
    got = remote.profiles(scans, ["name"], "content", client(o.client)).filter("width IS NOT NULL").withColumn("g", F.lit(0))
    n = batching.numbered(got, ["g"], ["name"]).withColumn("total", F.lit(got.count()))
    at = profile.split_at(F.col("brightness"), F.col("edges"), o.shadow_threshold)
    h = profile.halves(at, F.col("width"))
    stem, ext = F.regexp_replace("name", r"\.[^.]*$", ""), F.regexp_extract("name", r"(\.[^.]*)$", 1)
    half = lambda side, a, b: profile.crop_command(F.col("name"), tx.split_page_name(stem, F.col("position"), F.col("total"), F.lit(side), ext), h[a], h[b] - h[a], F.col("height"))
    d = batching.interleaved(n.select("position", half(1, "left_from", "left_to").alias("l"), half(2, "right_from", "right_to").alias("r")), "position", "l", "r")
    log = d.agg(render.in_order(F.struct("position", "side"), F.col("value")).alias("text")).select(F.lit("crop-commands.txt").alias("name"), F.concat("text", F.lit("\n")).alias("text"))
    files.export_texts(log, o.output, "name", "text")
    return 0


STEPS = {"batch": batch, "report": report, "audit": audit_folder, "extract": extract, "proofread": proofread, "recognise": recognise, "split": split}


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    o = parser().parse_args(args)
    if o.log_to_file:
        Path(o.log_to_file).mkdir(parents=True, exist_ok=True)
        handler = logging.FileHandler(Path(o.log_to_file) / f"foliant-{dt.datetime.now():%Y-%m-%dT%H%M}.log", encoding="utf-8")
        handler.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(message)s"))
        log.setLevel(logging.DEBUG)
        log.addHandler(handler)
    log.info("step %s with %s", o.step, {k: v for k, v in vars(o).items() if k != "client"})
    spark = spark or local_session()
    try:
        return STEPS[o.step](spark, o)
    finally:
        discard_kept(spark)


if __name__ == "__main__":
    sys.exit(main())
