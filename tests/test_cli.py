"""The command line on a small tree of files."""

import pytest

from foliant import cli

PAGE = "<div class='ocr_page' title='image {0}.jpg; bbox 0 0 100 140; ppageno {0}'><span class='ocr_line' title='bbox 1 1 9 9'><span class='ocrx_word' title='bbox 1 1 9 9'>{1}</span></span></div>"


def document(*words):
    return "<html><head><title>t</title></head>\n<body>\n" + "\n".join(PAGE.format(i + 1, w) for i, w in enumerate(words)) + "\n</body>\n</html>\n"


def test_batch_and_report(spark, tmp_path):
    (tmp_path / "images").mkdir()
    for n in ("1.jpg", "2.jpg", "3.jpg"):
        (tmp_path / "images" / n).write_bytes(b"x")
    (tmp_path / "book_all.hocr").write_text(document("one", "two", "three"), "utf-8")
    args = ["batch", "-f", str(tmp_path / "book_all.hocr"), "-i", str(tmp_path / "images"), "-o", str(tmp_path / "out"), "-b", "2"]
    assert cli.main(args, spark) == 0
    made = sorted(str(p.relative_to(tmp_path / "out")) for p in (tmp_path / "out").rglob("*") if p.is_file())
    assert made == ["batch_001-002/1.jpg", "batch_001-002/2.jpg", "batch_001-002/book_1-2.hocr", "batch_003/3.jpg", "batch_003/book_3.hocr"]
    text = (tmp_path / "out/batch_003/book_3.hocr").read_text("utf-8")
    assert "<!-- overall page 3: source image 3.jpg -->" in text and "three" in text and "two" not in text
    fixed = (tmp_path / "out/batch_001-002/book_1-2.hocr").read_text("utf-8").replace(">two<", ">TWO<")
    (tmp_path / "out/batch_001-002/book_1-2-proofread.hocr").write_text(fixed, "utf-8")
    assert cli.main(["report", "-i", str(tmp_path / "out"), "-o", str(tmp_path / "rep"), "--markdown", "--latex"], spark) == 0
    made = sorted(p.name for p in (tmp_path / "rep").rglob("*") if p.is_file())
    assert made == ["batch_001-002.diff", "book_1-2-proofread-diff.html", "book_1-2-proofread-merged.hocr", "book_1-2-proofread.diff", "book_1-2-proofread.md", "book_1-2-proofread.tex"]
    assert ">TWO<" in (tmp_path / "rep/book_1-2-proofread-merged.hocr").read_text("utf-8")
    assert "### Page 2 (2.jpg)" in (tmp_path / "rep/book_1-2-proofread.md").read_text("utf-8")
    (tmp_path / "images" / "4.jpg").write_bytes(b"x")
    assert cli.main(args, spark) == cli.EXIT_COUNT_MISMATCH


def test_audit(spark, tmp_path, capsys):
    for d, f, n in (("a", "x.hocr", 100), ("a", "x-proofread.hocr", 50), ("b", "x.hocr", 10)):
        (tmp_path / d).mkdir(exist_ok=True)
        (tmp_path / d / f).write_bytes(b"x" * n)
    (tmp_path / "c").mkdir()
    assert cli.main(["audit", str(tmp_path)], spark) == 0
    assert capsys.readouterr().out.splitlines() == ["a: x-proofread.hocr out of tolerance", "b: no matching file missing", "c: no matching file missing"]


@pytest.mark.parametrize("args", [["audit", "d", "-s", "50"], ["batch", "-f", "a", "-i", "b", "-o", "c", "-b", "0"], ["extract", "p", "--client", "m:f", "-t", "1.5"], []])
def test_bounds(args):
    with pytest.raises(SystemExit):
        cli.parser().parse_args(args)


def reader():
    def read(content):
        return (40, 10, [100.0] * 18 + [5.0] * 6 + [100.0] * 16, [0] * 40)

    return read


def recogniser():
    def read(content):
        line = ("Hello \"you\"", [1.0, 10.0, 50.0, 10.0, 50.0, 20.0, 1.0, 20.0])
        words = [("Hello", 0.29, [1.0, 10.0, 20.0, 10.0, 20.0, 20.0, 1.0, 20.0]), ('"you"', None, [22.0, 12.0, 50.0, 12.0, 50.0, 20.0, 22.0, 20.0])]
        return [(0, 100.0, 100.0, [line], words)]

    return read


def asker():
    def ask(prompt, images, temperature=None):
        return f"{prompt}|{len(images)}" if temperature is None else prompt.split("\n\n", 1)[1].replace("one", "ONE")

    return ask


def silent():
    return lambda prompt, image, temperature: "no page"


def frozen():
    return (lambda: 1_700_000_000.0), (lambda seconds: None)


def busy():
    """A client that is over its quota, then overloaded, then answers."""
    answers = iter([429, 503, None])

    def ask(prompt, image, temperature):
        code = next(answers)
        if code:
            e = RuntimeError("busy")
            e.code = code
            raise e
        return prompt.split("\n\n", 1)[1].replace("one", "ONE")

    return ask


class Clock:
    """A clock that only waits move, and that writes down each wait."""

    def __init__(self, path):
        self.t, self.path = 1_700_000_000.0, path

    def now(self):
        return self.t

    def sleep(self, seconds):
        self.t += seconds
        with open(self.path, "a") as f:
            f.write(f"{seconds:g}\n")


def test_steps_with_clients(spark, tmp_path):
    (tmp_path / "s" / "t").mkdir(parents=True)
    (tmp_path / "s" / "a.png").write_bytes(b"x")
    (tmp_path / "s" / "t" / "b.png").write_bytes(b"x")
    here = f"{__name__}"
    still = ["--clock", f"{here}:frozen"]
    assert cli.main(["split", str(tmp_path / "s"), "-o", str(tmp_path / "o"), "--client", f"{here}:reader"], spark) == 0
    log = (tmp_path / "o" / "crop-commands.txt").read_text("utf-8").splitlines()
    assert len(log) == 2 and "'a_split_1_1.png'" in log[0] and "a_split_1_2.png" in log[1]
    assert cli.main(["recognise", "-p", str(tmp_path / "s" / "**" / "*.png"), "-o", str(tmp_path / "r"), "--client", f"{here}:recogniser"], spark) == 0
    made = {p.suffix: p.read_text("utf-8") for p in (tmp_path / "r").iterdir()}
    assert sorted(made) == [".csv", ".hocr", ".md"]
    assert made[".csv"] == "filename,word,confidence,left_x,upper_y\n" + "".join(f'{n}.png,"Hello",0.2900,1,10\n{n}.png,"""you""",0.0000,22,12\n' for n in "ab")
    assert made[".md"] == '# OCR Results\n\n## Filename: a.png\n\nHello "you"\n\n## Filename: b.png\n\nHello "you"\n\n'
    assert '<div class="ocr_page" id="page_2" title="image b.png; bbox 0 0 100 100; ppageno 2">\n\t<div class="ocr_carea" id="carea_2_1">\n\t<span class="ocr_line" id="line_2_0" title="bbox 1 10 50 20">\n\t\t<span class="ocrx_word" id="word_2_0_0" title="bbox 1 10 20 20; x_wconf 28">Hello</span>\n' in made[".hocr"]
    assert cli.main(["recognise", "-p", str(tmp_path / "s" / "*.tif"), "-o", str(tmp_path / "r"), "--client", f"{here}:recogniser"], spark) == cli.EXIT_NO_INPUT
    assert cli.main(["recognise", "-p", str(tmp_path / "none" / "*.tif"), "-o", str(tmp_path / "r"), "--client", f"{here}:recogniser"], spark) == cli.EXIT_NO_INPUT
    assert cli.main(["extract", str(tmp_path / "s"), "-o", str(tmp_path / "e"), "-p", "read", "--first", "1", "--client", f"{here}:asker", *still], spark) == 0
    assert sorted(p.name.split("-")[0] + ":" + p.read_text("utf-8") for p in (tmp_path / "e").iterdir()) == ["output:read|1", "prompt:read"]
    b = tmp_path / "p" / "b1"
    b.mkdir(parents=True)
    (b / "a.png").write_bytes(b"x")
    (b / "x.hocr").write_text(document("one"), "utf-8")
    assert cli.main(["proofread", str(tmp_path / "p"), "--client", f"{here}:asker", *still], spark) == 0
    assert ">ONE<" in (b / "x-proofread.hocr").read_text("utf-8")
    c = tmp_path / "q" / "b2"
    c.mkdir(parents=True)
    (c / "a.png").write_bytes(b"x")
    (c / "x.hocr").write_text(document("one"), "utf-8")
    (c / "x-proofread.lasttemp").write_text("0.0", "utf-8")
    assert cli.main(["-l", str(tmp_path / "log"), "proofread", str(tmp_path / "q"), "-m", "2", "--client", f"{here}:silent", *still], spark) == 0
    assert not (c / "x-proofread.hocr").exists() and (c / "x-proofread.lasttemp").read_text("utf-8") == "0.2"
    failed = sorted(p.name.split(".")[1] for p in c.glob("*.failed"))
    assert failed == ["err", "hocr"] and len(list((tmp_path / "log").iterdir())) == 1


def _page_folder(at, name):
    d = at / name
    d.mkdir(parents=True)
    (d / "a.png").write_bytes(b"x")
    (d / "x.hocr").write_text(document("one"), "utf-8")
    return d


def test_proofread_retries_and_paces(spark, tmp_path, monkeypatch):
    waits = str(tmp_path / "waits")

    def turnstile(rows, name):
        c = Clock(waits)
        return cli.quota.Turnstile(rows, c.now, c.sleep)

    monkeypatch.setattr(cli, "turnstile", turnstile)
    d = _page_folder(tmp_path / "p", "b1")
    assert cli.main(["proofread", str(tmp_path / "p"), "--client", f"{__name__}:busy"], spark) == 0
    assert ">ONE<" in (d / "x-proofread.hocr").read_text("utf-8")
    # 429: 60 s; 503: 120 s; the page went through at once, so a minute until the next
    assert (tmp_path / "waits").read_text() == "60\n120\n60\n"


def test_quota_holds_calls(tmp_path):
    waits = tmp_path / "waits"
    c = Clock(str(waits))
    t = cli.quota.Turnstile([("requests_per_minute", 2, None, None), ("requests_per_day", 4, "00:00", "America/Los_Angeles")], c.now, c.sleep)
    said = []
    for _ in range(6):
        said.append(t.enter())
        if said[-1] == "ok":
            t.went_through()
    assert said == ["ok"] * 4 + ["requests_per_day"] * 2 and waits.read_text().startswith("60\n")
    assert 0 < t.to_reset() <= 86_400
    free = cli.quota.Turnstile([], c.now, c.sleep)
    assert free.enter() == "ok" and free.to_reset() == 60


def test_lone_files_are_no_part_of_the_documents(spark, tmp_path):
    (tmp_path / "in" / "a").mkdir(parents=True)
    (tmp_path / "in" / "b").mkdir()
    (tmp_path / "in" / "a" / "x_page1.hocr").write_text(document("one"), "utf-8")
    (tmp_path / "in" / "a" / "x_page1-proofread.hocr").write_text(document("ONE"), "utf-8")
    (tmp_path / "in" / "b" / "y.hocr").write_text(document("two"), "utf-8")
    for keep, words in (([], {"ONE"}), (["--keep-lone"], {"ONE", "two"})):
        out = tmp_path / f"out{len(keep)}"
        assert cli.main(["report", "-i", str(tmp_path / "in"), "-o", str(out), *keep], spark) == 0
        text = (out / "x-proofread-merged.hocr").read_text("utf-8")
        assert {w for w in ("ONE", "two") if f">{w}<" in text} == words
        report = (out / "x-proofread-diff.html").read_text("utf-8")
        assert "<title>Diff Report: x-proofread</title>" in report and '<div class="diff-line diff-header">=== a / x_page1-proofread.hocr ===</div>' in report
