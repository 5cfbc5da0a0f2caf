"""Column functions against plain Python."""

from pyspark.sql import Row
from pyspark.sql import functions as F

from foliant.functions import geometry as geo
from foliant.functions import text as tx


def values(spark, column, rows, name="x", kind="string"):
    df = spark.createDataFrame([(r,) for r in rows], f"{name} {kind}")
    return [r[0] for r in df.select(column(F.col(name))).collect()]


def test_box_and_numbers(spark):
    titles = ["image a.jpg; bbox 1 2 30 40; ppageno 7", "bbox -1 2 3 4", "", None, "bbox 1 2 3"]
    got = values(spark, tx.box_of, titles)
    assert got == [Row(x0=1, y0=2, x1=30, y1=40), None, None, None, None]
    assert values(spark, tx.page_number, titles) == ["7", None, None, None, None]


def test_image_name_of_the_overall_comment(spark):
    pages = ['<div><!-- other --><!-- overall page 3: source image 0003.jpg --></div>', "<div></div>", None]
    assert values(spark, tx.image_name, pages) == ["0003.jpg", None, None]


def test_latex_escape_is_a_fold_in_order(spark):
    rows = ["a\\b", "{x}", "$5 & 6% #_~^", "", None]

    def fold(s):
        for a, b in tx.LATEX_ESCAPES:
            s = s.replace(a, b)
        return s

    assert values(spark, tx.latex_escape, rows) == [None if r is None else fold(r) for r in rows]
    assert fold("\\") == r"\textbackslash\{\}"


def test_capitals(spark):
    rows = ["ÀBc1", "ABCDE F", "abc", "123", "", None]

    def share(s):
        letters = [c for c in s if c.isalpha()]
        return sum(c.isupper() for c in letters) / len(letters) if letters else None

    assert values(spark, tx.capital_share, rows) == [None if r is None else share(r) for r in rows]
    assert values(spark, tx.all_capitals, rows) == [False, True, False, False, False, False]


def test_diff_class_first_rule_wins(spark):
    rows = ["=== a", "+++ a", "--- a", "---x", "+a", "-a", "@@ 1", " a", "", None]
    assert values(spark, tx.diff_class, rows) == ["header", "info", "info", "info", "added", "removed", "info", "context", "context", "context"]


def test_answers(spark):
    rows = ["text", " \n", "", "<html></html> \n", None]
    assert values(spark, tx.response_status, rows) == ["ok", "empty string", "empty string", "ok", "no text"]
    page = lambda c: tx.response_status(c, True)
    assert values(spark, page, rows) == ["no closing </html> tag", "no closing </html> tag", "no closing </html> tag", "ok", "no text"]


def test_names(spark):
    assert values(spark, tx.original_name, ["x_1-proofread.hocr", "a-proofread-proofread.hocr", "b.hocr", None]) == ["x_1.hocr", "a-proofread.hocr", "b.hocr", None]
    df = spark.createDataFrame([("book-all.hocr", 1, 20), ("book.hocr", 7, 7), ("Book_ALL.hocr", 21, 25)], "n string, a int, b int")
    got = df.select(tx.batch_file(F.col("n"), F.col("a"), F.col("b")), tx.batch_folder(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in got] == [("book_1-20.hocr", "batch_001-020"), ("book_7.hocr", "batch_007"), ("Book_21-25.hocr", "batch_021-025")]
    assert values(spark, tx.mime_type, ["a.PNG", "b.jpeg", "c.txt", "d", None]) == ["image/png", "image/jpeg", "application/octet-stream", "application/octet-stream", "application/octet-stream"]
    assert values(spark, tx.first_integer, ["p12b3", "x", None]) == [12, None, None]


def test_confidence_cuts_off(spark):
    assert values(spark, tx.confidence_percent, [0.29, 0.0, None, 1.0], kind="double") == [28, 0, 0, 100]
    assert values(spark, tx.confidence_text, [0.29, 0.0, None], kind="double") == ["0.2900", "0.0000", "0.0000"]


def test_paragraph_gap_at_the_limit(spark):
    rows = [((0, 0, 10, 10), (0, 24, 10, 34)), ((0, 0, 10, 10), (0, 25, 10, 35)), ((0, 0, 10, 10), (0, 26, 10, 36))]
    df = spark.createDataFrame(rows, f"a {tx.BOX}, b {tx.BOX}")
    assert [r[0] for r in df.select(geo.is_new_paragraph(F.col("a"), F.col("b"))).collect()] == [False, False, True]


def test_usual_x_half_even_and_first_seen(spark):
    rows = [(1, 0, 25), (1, 1, 35), (1, 2, 44), (2, 0, 17), (2, 1, 52), (3, 0, None)]
    df = spark.createDataFrame(rows, "p int, i int, x int")
    got = {r.p: r.usual_x for r in geo.usual_x(df, ["p"], "i", F.col("x")).collect()}
    assert got == {1: 40, 2: 20}  # 25 -> 20, 35 -> 40, 44 -> 40; of ties the first seen
