"""Page bytes in declared encodings; CSV records that span lines and splits, as ``csv.reader`` reads them."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from flatwatch.functions.charset import LABELS, decode_page, declared, encode_single_byte
from flatwatch.sources.cities import csv_cells, csv_records, read_city_dictionary
from flatwatch.sources.pages import read_html_files

TEXT = "Zażółć gęślą jaźń – 1 234 zł"


@pytest.mark.parametrize("content,header,want", [
    (TEXT.encode(), None, TEXT),
    (("<meta charset=ISO-8859-2>" + TEXT.replace("–", "-")).encode("iso-8859-2"), None, "<meta charset=ISO-8859-2>" + TEXT.replace("–", "-")),
    (('<META http-equiv="x" content="text/html; charset=cp1250">' + TEXT).encode("cp1250"), None,
     '<META http-equiv="x" content="text/html; charset=cp1250">' + TEXT),
    (TEXT.encode("cp1250"), "text/html; charset=windows-1250", TEXT),
    (TEXT.encode("cp1250"), 'text/html; charset="Windows-1250"', TEXT),
    (b"\xef\xbb\xbf" + TEXT.encode(), "text/html; charset=windows-1250", TEXT),
    (b"\xff\xfe" + TEXT.encode("utf-16le"), None, TEXT),
    (b"\xfe\xff" + TEXT.encode("utf-16be") + b"\0", None, TEXT),
    (("<meta charset=koi9>" + TEXT).encode(), "text/html", "<meta charset=koi9>" + TEXT),
    (b"a\xffb", None, "a�b"),
    (b"", None, ""),
    (None, None, None),
])
def test_bytes_to_text(spark, content, header, want):
    df = spark.createDataFrame([(content, header)], "c binary, h string")
    assert df.select(decode_page(F.col("c"), declared(F.col("c"), F.col("h")))).first()[0] == want


def test_all_single_bytes(spark):
    for name in LABELS:
        if name == "utf-8":
            continue
        whole = bytes(range(1, 256))
        want = whole.decode(name, "replace")
        df = spark.createDataFrame([(whole,)], "c binary")
        text = df.select(decode_page(F.col("c"), F.lit(name)).alias("t"))
        assert text.first()[0] == want
        kept = want.replace("�", "")
        assert spark.createDataFrame([(kept,)], "t string").select(encode_single_byte(F.col("t"), name)).first()[0] == bytearray(kept.encode(name))


def test_files_and_page_numbers(spark, tmp_path):
    for folder, name, encoding in (("run9", "page-3.html", "utf-8"), ("2024-03-04", "index.html", "iso-8859-2"), ("x7", "12.htm", "cp1250")):
        (tmp_path / folder).mkdir()
        text = f"<meta charset={encoding}>zażółć"
        (tmp_path / folder / name).write_bytes(text.encode(encoding))
    got = {r.page: r.html for r in read_html_files(spark, str(tmp_path / "*"), "portal_b", "rent").collect()}
    assert got == {3: "<meta charset=utf-8>zażółć", None: "<meta charset=iso-8859-2>zażółć", 12: "<meta charset=cp1250>zażółć"}


def grid(rng, n):
    cell = lambda: "".join(rng.choice(['a', 'ł', ' ', ',', '"', '\n', 'x"y', '""']) for _ in range(rng.randint(0, 6)))
    out = io.StringIO()
    for _ in range(n):
        if rng.random() < 0.3:                       # quotes where csv writers put none
            out.write(rng.choice(['a"b,c', '"q"z,"', 'x,"y\n"",z"', 'plain', '', '"a""b",c']) + ("\n" if rng.random() < .9 else '"\n'))
        else:
            csv.writer(out, lineterminator="\n").writerow([cell() for _ in range(rng.randint(1, 4))])
    return out.getvalue()


@pytest.mark.parametrize("seed", range(4))
def test_records_as_csv_reader(spark, seed):
    """Lines of a few files dealt into splits of any size."""
    rng = random.Random(seed)
    rows, want = [], []
    for f in range(6):
        text = grid(rng, 25)
        want += [(f, r) for r in csv.reader(io.StringIO(text.removesuffix("\n")))]    # a quote never closed ends with the last line
        lines, block = text.removesuffix("\n").split("\n"), 0
        for i, line in enumerate(lines):
            block += rng.random() < 0.3
            rows.append((f, block, i, line))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "file int, block int, at int, value string").repartition(3)
    got = [(r.file, r.c) for r in csv_records(df, "file", ["block", "at"]).select("file", csv_cells(F.col("record")).alias("c")).collect()]
    plain = lambda rs: sorted((f, [c for c in r if c]) for f, r in rs if any(r))  # noqa: E731  the dictionary drops empty cells
    assert plain(got) == plain(want)


def test_dictionary_with_line_breaks_over_splits(spark, tmp_path):
    cities = [f'City "{i}"\nline {i}' if i % 3 else f"Town {i}" for i in range(3000)]
    path = tmp_path / "cities.csv"
    with open(path, "w", newline="") as f:
        csv.writer(f, lineterminator="\n").writerows([c, "", "Łódź"] for c in cities)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = read_city_dictionary(spark, str(path))
        assert sorted(r.city for r in df.collect()) == sorted({*cities, "Łódź"})
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
