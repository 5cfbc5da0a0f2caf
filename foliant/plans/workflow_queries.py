"""Queries on the workflow around pages: batches, pairs of files, audits, quotas, retries, differences, splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions import text as tx
from foliant.operators import audit, batching, diff, profile, quota, render, retry, roles
from foliant.plans.page_queries import BOXED, FILES, WORDS, current_files, current_lines, current_pages, current_words
from foliant.sources.tables import current_rows, only_current, table

BATCH = 20


def current_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_rows(table(spark, sf_dir, "call_log"), "call_id", ["call_id", "model", "ts", "tokens", "status"])


def _sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with their size in characters."""
    size = F.coalesce(F.aggregate("pages_html", F.lit(0), lambda a, p: a + F.coalesce(F.char_length(p), F.lit(0))), F.lit(0)).cast("long")
    return current_files(spark, sf_dir, "volume_id", "batch_dir", "file_name", "role", "mtime", size.alias("size"))


def batch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of twenty documents of each source, with folder and file names."""
    n = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n"))
    named = batching.batch_ranges(n, ["source"], "n", BATCH).withColumn("name", F.concat(F.coalesce("source", F.lit("unknown")), F.lit("_all.hocr")))
    return batching.batch_names(named, "name").select("source", "batch_idx", "start", "end", "folder", "file")


def batch_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each file's place in its volume and the batch it falls into."""
    f = current_files(spark, sf_dir, "volume_id", "file_name").select("hocr_id", "volume_id", "file_name")
    return batching.numbered(f, ["volume_id"], ["hocr_id"]).select("hocr_id", "volume_id", "position", batching.batch_of(F.col("position"), BATCH).alias("batch_idx"))


def overall_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of each page in its volume, over files in their order."""
    n = F.size(F.coalesce("pages_html", F.array().cast("array<string>")))
    f = current_files(spark, sf_dir, "volume_id", n.alias("n")).filter("n > 0")
    p = f.select("volume_id", "hocr_id", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("page_idx"))
    return batching.numbered(p, ["volume_id"], ["hocr_id", "page_idx"], "overall")


def zipped_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The k-th image of a volume's word export with its k-th page."""
    images = table(spark, sf_dir, "word_csv").select(F.regexp_extract("filename", r"^(.*)_[0-9]+\.", 1).alias("volume_id"), "filename").distinct()
    pages = current_lines(spark, sf_dir).select("volume_id", "hocr_id", "page_idx").distinct()
    return batching.zipped(images, pages, ["volume_id"], ["filename"], ["hocr_id", "page_idx"]).select("volume_id", "position", "filename", "hocr_id", "page_idx")


def unequal_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volumes with different numbers of images and pages."""
    images = table(spark, sf_dir, "word_csv").select(F.regexp_extract("filename", r"^(.*)_[0-9]+\.", 1).alias("volume_id"), "filename").distinct()
    pages = current_lines(spark, sf_dir).select("volume_id", "hocr_id", "page_idx").distinct()
    return batching.count_mismatches(images, pages, ["volume_id"])


def middle_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files 2 to 5 of each volume: a range as an operator chooses one."""
    f = current_files(spark, sf_dir, "volume_id", "file_name").select("volume_id", "hocr_id", "file_name")
    return batching.selected_range(f, ["volume_id"], ["hocr_id"], 2, 5)


def halves_in_turn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of the left and right halves that each file's scan would split into, in turn."""
    f = current_files(spark, sf_dir, "file_name").select("hocr_id", F.regexp_replace("file_name", r"\.hocr$", "").alias("stem"))
    name = lambda side: tx.split_page_name(F.col("stem"), F.pmod("hocr_id", F.lit(100)), F.lit(100), F.lit(side), F.lit(".png"))
    return batching.interleaved(f.select("hocr_id", name(1).alias("l"), name(2).alias("r")), "hocr_id", "l", "r")


def image_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images of the word export: MIME type, and which steps take them."""
    f = table(spark, sf_dir, "word_csv").select("filename").distinct()
    return f.select("filename", tx.mime_type(F.col("filename")).alias("mime"), *[tx.is_image(F.col("filename"), s).alias(s) for s in ("recognise", "batch", "split")])


def resolved_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The original and the corrected file of each batch of a volume, by name and time."""
    return roles.resolved(current_files(spark, sf_dir, "volume_id", "batch_dir", "file_name", "mtime"), ["volume_id", "batch_dir"], "file_name", "mtime")


def report_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base name of each batch's report."""
    r = roles.resolved(current_files(spark, sf_dir, "volume_id", "batch_dir", "file_name", "mtime"), ["volume_id", "batch_dir"], "file_name", "mtime")
    return r.select("volume_id", "batch_dir", roles.base_name(F.lit(None).cast("string"), F.col("proofread"), F.col("batch_dir")).alias("name"))


def pending_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches that still hold exactly one file."""
    f = current_files(spark, sf_dir, "volume_id", "batch_dir", "file_name").select(F.concat_ws("/", "volume_id", "batch_dir").alias("folder"), "file_name")
    return audit.pending(f, "folder", "file_name")


def size_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corrected files against the originals of their names, within ten percent of size; batches without one."""
    f = _sizes(spark, sf_dir).withColumn("folder", F.concat_ws("/", "volume_id", "batch_dir"))
    return audit.audited(f, "folder", "file_name", "size").select("folder", "name", "original_name", "size", "original_size", "status")


def copy_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each file's size against the size of its copy in the other system."""
    sizes = lambda t: table(spark, sf_dir, t).select("hocr_id", "loaded_at", F.aggregate(F.coalesce("pages_html", F.array().cast("array<string>")), F.lit(0), lambda a, p: a + F.coalesce(F.char_length(p), F.lit(0))).cast("long").alias("size"))
    a = current_rows(sizes("hocr_structure"), "hocr_id", ["hocr_id", "size"])
    b = current_rows(sizes("hocr_structure_copy"), "hocr_id", ["hocr_id", F.col("size").alias("copy_size")])
    return a.join(b, "hocr_id", "left").withColumn("status", audit.size_class(F.col("size"), F.col("copy_size")))


def word_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The word export's rows as they are written, digested by image."""
    w = current_rows(table(spark, sf_dir, "word_csv"), "csv_id", ["csv_id", "filename", "word", "confidence", "left_x", "upper_y"]).filter(F.col("word").isNotNull())
    row = render.word_csv_rows(F.col("filename"), F.col("word"), F.col("confidence").try_cast("double"), F.col("left_x"), F.col("upper_y"))
    return w.withColumn("row", row).groupBy("filename").agg(render.in_order(F.col("csv_id"), F.col("row")).alias("t"), F.sum(tx.confidence_percent(F.col("confidence").try_cast("double"))).alias("percent")).select("filename", F.md5(F.col("t").cast("binary")).alias("digest"), "percent")


def polygon_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of words as polygons with fractions, and back."""
    b = F.col("bbox")
    corners = F.array(*[(c + F.lit(0.75)).cast("double") for c in (b["x0"], b["y0"], b["x1"], b["y0"], b["x1"], b["y1"], b["x0"], b["y1"])])
    box = tx.polygon_box(corners)
    return current_words(spark, sf_dir).filter(b.isNotNull()).select("word_id", box["x0"].alias("x0"), box["y1"].alias("y1"))


def joined_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of each file joined in order: length and digest."""
    p = current_pages(spark, sf_dir).groupBy("hocr_id").agg(F.count("*").alias("n_pages"), render.in_order(F.col("page_idx"), F.col("html"), "\n").alias("t"))
    return p.select("hocr_id", "n_pages", F.md5(F.col("t").cast("binary")).alias("digest"))


def merged_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corrected files of each volume as the parts of one document: parts, characters, digests of all pages added up."""
    f = only_current(table(spark, sf_dir, "hocr_structure").select("hocr_id", "volume_id", "role", "prefix_before_body", "pages_html", "loaded_at"), table(spark, sf_dir, "hocr_structure"), "hocr_id").dropDuplicates(["hocr_id"])
    f = f.filter(F.col("role").isin("proofread", "corrected") & F.col("pages_html").isNotNull())
    m = render.merged_parts(f.select("volume_id", F.lpad(F.col("hocr_id").cast("string"), 12, "0").alias("batch_dir"), F.col("prefix_before_body").alias("prefix"), F.col("pages_html").alias("pages")), "volume_id")
    page = (F.col("part") >= 0) & F.col("batch_dir").isNotNull()
    digest = F.conv(F.substring(F.md5(F.rtrim(F.col("text"), F.lit("\n")).cast("binary")), 1, 8), 16, 10).cast("long")
    return m.groupBy("volume_id").agg(F.count(F.when(page, 1)).alias("n_pages"), F.sum(F.when(page, F.char_length("text") - 1).otherwise(0)).alias("n_chars"), F.sum(F.when(page, digest).otherwise(0)).alias("digests"))


def minute_use(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests and tokens of the 60 seconds up to each call."""
    return quota.rolling_minute(current_calls(spark, sf_dir).filter(F.col("model").isNotNull() & F.col("ts").isNotNull())).select("call_id", "model", "requests_60s", "tokens_60s")


def daily_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Use of each quota day against the daily limit."""
    return quota.daily_use(current_calls(spark, sf_dir).filter(F.col("ts").isNotNull()), table(spark, sf_dir, "quota_config"))


def reset_waits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seconds from each call to its model's next reset, by elapsed time."""
    q = table(spark, sf_dir, "quota_config").filter(F.col("quota_type") == "requests_per_day").select("model", "reset_time", "reset_timezone")
    d = current_calls(spark, sf_dir).filter(F.col("ts").isNotNull()).join(q, "model", "left")
    return d.select("call_id", quota.seconds_to_reset(F.col("ts"), F.col("reset_time"), F.col("reset_timezone"), compat=False).alias("wait_s"))


def admissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which calls the quotas would have let through, in order of time."""
    return quota.admissions(current_calls(spark, sf_dir), table(spark, sf_dir, "quota_config"))


def error_delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each failed call's class, and its delay before a first retry."""
    code = F.regexp_extract("status", r"([0-9]{3})", 1).try_cast("int")
    d = current_calls(spark, sf_dir).filter(F.col("status") != "ok").withColumn("code", code)
    return d.select("call_id", F.coalesce(retry.error_status(F.col("code")), F.lit("error")).alias("cls"), retry.retry_delay(F.lit(1), retry.extra_delay(F.col("code"), F.lit(None).cast("string"), F.lit(0))).alias("delay_s"))


def temperature_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Temperatures of six attempts, as the workflow saves and rereads them, and plainly."""
    a, b = retry.temperatures(0.0, 6), retry.temperatures(0.0, 6, compat=False)
    return spark.createDataFrame([(k, round(x, 6), round(y, 6)) for k, (x, y) in enumerate(zip(a, b, strict=True))], "attempt int, compat double, plain double")


def line_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines in which the pages of both systems' copies of a file differ."""
    pages = lambda t, c: current_rows(table(spark, sf_dir, t).select("hocr_id", "loaded_at", F.array_join(F.coalesce("pages_html", F.array().cast("array<string>")), "\n").alias(c)), "hocr_id", ["hocr_id", c])
    both = pages("hocr_structure", "a").join(pages("hocr_structure_copy", "b"), "hocr_id")
    return diff.line_differences(both, ["hocr_id"], "a", "b", compat=False)


def splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where scans would be split whose column profiles are the embeddings, scaled to brightness."""
    v = table(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda x: F.floor(F.abs(x) * 400).cast("double")).alias("p"))
    return v.select("vec_id", profile.shadow_split(F.col("p")).alias("shadow"), profile.geometric_split(F.col("p")).alias("edge"), profile.split_at(F.col("p"), F.col("p")).alias("split"))


QUERIES = {
    "batch_plan": batch_plan, "batch_members": batch_members, "overall_pages": overall_pages, "zipped_pages": zipped_pages, "unequal_counts": unequal_counts, "middle_range": middle_range, "halves_in_turn": halves_in_turn,
    "image_kinds": image_kinds, "resolved_roles": resolved_roles, "report_names": report_names, "pending_folders": pending_folders, "size_audit": size_audit, "copy_audit": copy_audit, "word_rows": word_rows,
    "polygon_boxes": polygon_boxes, "joined_pages": joined_pages, "merged_volumes": merged_volumes, "minute_use": minute_use, "daily_quota": daily_quota, "reset_waits": reset_waits, "admissions": admissions,
    "error_delays": error_delays, "temperature_plan": temperature_plan, "line_differences": line_differences, "splits": splits,
}

CALLS = "(SELECT * FROM call_log QUALIFY row_number() OVER (PARTITION BY call_id ORDER BY loaded_at DESC) = 1)"
DAILY = "(SELECT model, quota_limit, reset_time, reset_timezone FROM quota_config WHERE quota_type = 'requests_per_day')"
IMAGES = "(SELECT DISTINCT regexp_extract(filename, '^(.*)_[0-9]+\\.', 1) AS volume_id, filename FROM word_csv)"
TEXT_PAGES = f"(SELECT DISTINCT volume_id, hocr_id, page_idx FROM (SELECT * FROM ocr_lines QUALIFY row_number() OVER (PARTITION BY line_id ORDER BY loaded_at DESC) = 1))"
SIZED = "(SELECT *, coalesce(list_sum(list_transform(pages_html, lambda p: coalesce(length(p), 0))), 0)::BIGINT AS size FROM {0})"
COPIES = "(SELECT * FROM hocr_structure_copy QUALIFY row_number() OVER (PARTITION BY hocr_id ORDER BY loaded_at DESC) = 1)"
FOLDERED = f"(SELECT *, volume_id || '/' || batch_dir AS folder FROM {SIZED.format(FILES)})"


def _class(size: str, other: str) -> str:
    return f"CASE WHEN {size} = 0 THEN 'zero size' WHEN {other} IS NULL THEN 'no original' WHEN {other} = 0 THEN 'zero original' WHEN {size} < greatest(trunc({other} * 0.9::DOUBLE)::BIGINT, 1) OR {size} > trunc({other} * 1.1::DOUBLE)::BIGINT THEN 'out of tolerance' ELSE 'ok' END"


ROLES = f"""(
    SELECT volume_id, batch_dir, n_files, CASE WHEN n_files > 1 AND later IS NOT NULL THEN o END AS original, CASE WHEN n_files = 1 THEN only_one ELSE coalesce(later, o) END AS proofread FROM (
      SELECT volume_id, batch_dir, count(*) AS n_files, min(file_name) AS only_one, (min((mtime, file_name)) FILTER (WHERE r = 'original'))[2] AS o,
        coalesce((min((-epoch_us(mtime), file_name)) FILTER (WHERE r = 'corrected'))[2], (min((-epoch_us(mtime), file_name)) FILTER (WHERE r = 'proofread'))[2]) AS later
      FROM (SELECT *, CASE WHEN lower(file_name) LIKE '%.hocr' AND lower(file_name) NOT LIKE '%proofread%' AND lower(file_name) NOT LIKE '%corrected%' THEN 'original'
        WHEN lower(file_name) LIKE '%-corrected.hocr' THEN 'corrected' WHEN lower(file_name) LIKE '%-proofread.hocr' THEN 'proofread' END AS r FROM {FILES} WHERE file_name IS NOT NULL) GROUP BY ALL))"""

_LOCAL = "((ts AT TIME ZONE 'UTC') AT TIME ZONE coalesce(reset_timezone, 'UTC'))"
_OFFSET = "to_minutes((split_part(coalesce(reset_time, '00:00'), ':', 1)::INTEGER * 60 + split_part(coalesce(reset_time, '00:00'), ':', 2)::INTEGER)::BIGINT)"

ORACLE = {
    "batch_plan": f"""
        SELECT source, (s / {BATCH})::INTEGER AS batch_idx, s::INTEGER AS start, least(s + {BATCH}, n)::INTEGER AS "end",
          CASE WHEN s + 1 = least(s + {BATCH}, n) THEN printf('batch_%03d', s + 1) ELSE printf('batch_%03d-%03d', s + 1, least(s + {BATCH}, n)) END AS folder,
          coalesce(source, 'unknown') || '_' || CASE WHEN s + 1 = least(s + {BATCH}, n) THEN (s + 1)::VARCHAR ELSE (s + 1) || '-' || least(s + {BATCH}, n) END || '.hocr' AS file
        FROM (SELECT source, count(*) AS n FROM documents GROUP BY source), unnest(range(0, n, {BATCH})) AS t(s)""",
    "batch_members": f"SELECT hocr_id, volume_id, p::INTEGER AS position, floor((p - 1) / {BATCH})::INTEGER AS batch_idx FROM (SELECT *, row_number() OVER (PARTITION BY volume_id ORDER BY hocr_id) AS p FROM {FILES})",
    "overall_pages": f"SELECT volume_id, hocr_id, (i - 1)::INTEGER AS page_idx, row_number() OVER (PARTITION BY volume_id ORDER BY hocr_id, i)::INTEGER AS overall FROM {FILES}, unnest(range(1, len(pages_html) + 1)) AS t(i)",
    "zipped_pages": f"""
        SELECT volume_id, position::INTEGER AS position, filename, hocr_id, page_idx FROM (SELECT *, row_number() OVER (PARTITION BY volume_id ORDER BY filename) AS position FROM {IMAGES})
        JOIN (SELECT *, row_number() OVER (PARTITION BY volume_id ORDER BY hocr_id, page_idx) AS position FROM {TEXT_PAGES}) USING (volume_id, position)""",
    "unequal_counts": f"SELECT volume_id, coalesce(a, 0) AS n_left, coalesce(b, 0) AS n_right FROM (SELECT volume_id, count(*) AS a FROM {IMAGES} GROUP BY 1) FULL JOIN (SELECT volume_id, count(*) AS b FROM {TEXT_PAGES} GROUP BY 1) USING (volume_id) WHERE coalesce(a, 0) <> coalesce(b, 0)",
    "middle_range": f"SELECT volume_id, hocr_id, file_name, p::INTEGER AS position FROM (SELECT *, row_number() OVER (PARTITION BY volume_id ORDER BY hocr_id) AS p FROM {FILES}) WHERE p BETWEEN 2 AND 5",
    "halves_in_turn": f"SELECT hocr_id, side::INTEGER AS side, regexp_replace(file_name, '\\.hocr$', '') || '_split_' || lpad((hocr_id % 100)::VARCHAR, 3, '0') || '_' || (side + 1) || '.png' AS value FROM {FILES}, unnest(range(0, 2)) AS t(side)",
    "image_kinds": """
        SELECT filename, CASE e WHEN 'png' THEN 'image/png' WHEN 'jpg' THEN 'image/jpeg' WHEN 'jpeg' THEN 'image/jpeg' WHEN 'tif' THEN 'image/tiff' WHEN 'tiff' THEN 'image/tiff' WHEN 'jp2' THEN 'image/jp2' ELSE 'application/octet-stream' END AS mime,
          e IN ('png', 'jpg', 'jpeg', 'tif', 'tiff', 'jp2') AS recognise, e IN ('png', 'jpg', 'jpeg', 'tif', 'tiff', 'bmp', 'gif', 'webp', 'jp2') AS batch, e IN ('pdf', 'jpg', 'jpeg', 'png', 'tiff', 'tif', 'bmp', 'jp2') AS split
        FROM (SELECT DISTINCT filename, lower(regexp_extract(filename, '\\.([^./\\\\]+)$', 1)) AS e FROM word_csv)""",
    "resolved_roles": f"SELECT volume_id, batch_dir, original, proofread, n_files FROM {ROLES}",
    "report_names": f"SELECT volume_id, batch_dir, coalesce(replace(replace(replace(replace(replace(regexp_replace(proofread, '\\.[^.]*$', ''), '_proofread', ''), '_corrected', ''), '_edited', ''), '_page1', ''), '_page_1', ''), batch_dir) AS name FROM {ROLES}",
    "pending_folders": f"SELECT folder, min(file_name) AS file_name FROM {FOLDERED} WHERE file_name LIKE '%.hocr' GROUP BY folder HAVING count(*) = 1",
    "size_audit": f"""
        WITH f AS (SELECT folder, file_name, size FROM {FOLDERED}), m AS (SELECT folder, file_name AS name, size, regexp_replace(file_name, '-proofread', '') AS original_name FROM f WHERE regexp_matches(file_name, '-proofread\\.hocr$')),
        o AS (SELECT folder, file_name AS original_name, min(size) AS original_size FROM f GROUP BY ALL)
        SELECT folder, name, original_name, size, original_size, {_class("size", "original_size")} AS status FROM m LEFT JOIN o USING (folder, original_name)
        UNION ALL SELECT DISTINCT folder, NULL, NULL, NULL::BIGINT, NULL::BIGINT, 'missing' FROM f WHERE folder NOT IN (SELECT folder FROM m)""",
    "copy_audit": f"SELECT a.hocr_id, a.size, b.size AS copy_size, {_class('a.size', 'b.size')} AS status FROM {SIZED.format(FILES)} a LEFT JOIN {SIZED.format(COPIES)} b ON a.hocr_id = b.hocr_id",
    "word_rows": """
        SELECT filename, md5(string_agg(r, chr(10) ORDER BY csv_id)) AS digest, sum(coalesce(trunc(c * 100)::INTEGER, 0))::BIGINT AS percent FROM (
          SELECT *, concat_ws(',', filename, '"' || replace(word, '"', '""') || '"', CASE WHEN c IS NULL OR c = 0 THEN '0.0000' ELSE printf('%.4f', c) END, left_x::VARCHAR, upper_y::VARCHAR) AS r
          FROM (SELECT *, TRY_CAST(confidence AS DOUBLE) AS c FROM word_csv WHERE TRUE QUALIFY row_number() OVER (PARTITION BY csv_id ORDER BY loaded_at DESC) = 1) WHERE word IS NOT NULL) GROUP BY filename""",
    "polygon_boxes": f"SELECT word_id, bbox.x0 AS x0, bbox.y1 AS y1 FROM {WORDS} WHERE bbox IS NOT NULL",
    "joined_pages": f"SELECT hocr_id, count(*) AS n_pages, md5(string_agg(p, chr(10) ORDER BY i)) AS digest FROM (SELECT hocr_id, i, pages_html[i] AS p FROM {FILES}, unnest(range(1, len(pages_html) + 1)) AS t(i)) WHERE p IS NOT NULL GROUP BY hocr_id",
    "merged_volumes": f"""
        SELECT volume_id, count(p) AS n_pages, coalesce(sum(length(p)), 0)::BIGINT AS n_chars, coalesce(sum(('0x' || substr(md5(rtrim(p, chr(10))), 1, 8))::BIGINT), 0)::BIGINT AS digests
        FROM (SELECT volume_id, unnest(pages_html || [NULL]) AS p FROM {FILES} WHERE role IN ('proofread', 'corrected') AND pages_html IS NOT NULL) GROUP BY volume_id""",
    "minute_use": f"""
        SELECT call_id, model, count(*) OVER w AS requests_60s, coalesce(sum(tokens) OVER w, 0)::BIGINT AS tokens_60s FROM (SELECT *, epoch_us(ts) AS us FROM {CALLS} WHERE model IS NOT NULL AND ts IS NOT NULL)
        WINDOW w AS (PARTITION BY model ORDER BY us RANGE BETWEEN 59999999 PRECEDING AND CURRENT ROW)""",
    "daily_quota": f"""
        SELECT model, day, count(*) AS requests, coalesce(sum(tokens), 0)::BIGINT AS tokens, max(quota_limit) AS "limit", coalesce(greatest(count(*) - max(quota_limit), 0), 0)::BIGINT AS rejected
        FROM (SELECT c.*, quota_limit, ({_LOCAL} - {_OFFSET})::DATE AS day FROM {CALLS} c LEFT JOIN {DAILY} USING (model) WHERE ts IS NOT NULL) GROUP BY model, day""",
    "reset_waits": f"""
        SELECT call_id, coalesce(greatest(trunc(epoch(((((({_LOCAL} - {_OFFSET})::DATE + 1)::TIMESTAMP + {_OFFSET}) AT TIME ZONE coalesce(reset_timezone, 'UTC')) AT TIME ZONE 'UTC') - ts)), 0), 60)::INTEGER AS wait_s
        FROM (SELECT c.*, reset_time, reset_timezone FROM {CALLS} c LEFT JOIN {DAILY} USING (model) WHERE ts IS NOT NULL) WHERE reset_time IS NOT NULL
        UNION ALL SELECT call_id, 60 FROM {CALLS} c LEFT JOIN {DAILY} USING (model) WHERE ts IS NOT NULL AND reset_time IS NULL""",
    "error_delays": f"""
        SELECT call_id, CASE WHEN code = 429 THEN 'error_429' WHEN code = 503 THEN 'error_503' ELSE 'error' END AS cls, 60 + CASE WHEN code IS NULL THEN 0 WHEN code = 503 THEN 120 ELSE 60 END AS delay_s
        FROM (SELECT *, TRY_CAST(regexp_extract(status, '([0-9]{{3}})', 1) AS INTEGER) AS code FROM {CALLS} WHERE status <> 'ok')""",
    "temperature_plan": "SELECT * FROM (VALUES (0, 0.0::DOUBLE, 0.0::DOUBLE), (1, 0.2, 0.1), (2, 0.4, 0.2), (3, 0.7, 0.3), (4, 1.0, 0.4), (5, 1.0, 0.5)) AS t(attempt, compat, plain)",
    "splits": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(abs(x) * 400)) AS p, len(embedding) AS w FROM embeddings),
        a AS (SELECT *, (w // 2 - (w // 4) // 2) AS s4, (w // 2 - (w // 3) // 2) AS s3 FROM v),
        b AS (SELECT *, p[s4 + 1 : s4 + greatest(w // 4, 1)] AS c4, p[s3 + 1 : s3 + greatest(w // 3, 1)] AS c3 FROM a),
        c AS (SELECT *, list_min(c4) AS d, list_filter(range(0, len(c4)), lambda i: c4[i + 1] <= list_min(c4) + 10) AS dark FROM b),
        e AS (SELECT vec_id, CASE WHEN d <= 50 AND len(dark) >= 5 THEN (s4 + (dark[1] + dark[len(dark)]) // 2)::INTEGER END AS shadow,
          CASE WHEN list_max(c3) > 0 THEN (s3 + list_position(c3, list_max(c3)) - 1)::INTEGER ELSE (w // 2)::INTEGER END AS edge FROM c)
        SELECT vec_id, shadow, edge, coalesce(shadow, edge) AS split FROM e""",
}
