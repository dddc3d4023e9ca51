"""Records of quoted, ragged, multi-line files against Python's csv module, with files in many splits."""

import csv
import io
import random

import pytest

from tallyloom.sources import delimited as D
from tallyloom.sources import seeds


def expected(text):
    out, reader = [], csv.reader(io.StringIO(text, newline=""), delimiter="\t")
    at = 0
    for row in reader:
        if row:
            out.append((at, row))
        at = reader.line_num
    return out


def made(rng):
    cell = lambda: rng.choice(["", "a", "b c", '"q"', '"x\ty"', '"l1\nl2"', '"l1\r\n\r\nl2"', '"d""d"', '""""', '""', 'mid"dle', 'e"', '"t"ail', '"t"a"il', '"\n"', '"a\n""\nb"', "é你"])
    return "".join("\t".join(cell() for _ in range(rng.randrange(1, 6))) + rng.choice(["\n", "\r\n"]) for _ in range(rng.randrange(1, 60)))


@pytest.mark.parametrize("size", ["64m", "40b"])
def test_equals_the_csv_module(spark, tmp_path, size):
    rng = random.Random(size)
    texts = {f"f{k}.tsv": made(rng) for k in range(12)} | {"open.tsv": 'a\tb\n"never\tclosed\nx\ty\n', "empty.tsv": "", "none.tsv": "\n\n", "bare.tsv": "a\t\tb", "tab.tsv": "\tx\n\t\n", "turns.tsv": '"a\nb"\t"c\nd"\t"e\nf"\ng\n'}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = D.records(spark, str(tmp_path))
        parts = spark.read.text(str(tmp_path)).rdd.getNumPartitions()
        got = sorted((r.file, r.line_no, list(r.cells)) for r in rows.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert size == "64m" or parts > 100
    wanted = sorted((name, at, row) for name, text in texts.items() for at, row in expected(text))
    # of a quote that is never closed the csv module keeps the last line end; here it is no part of the cell
    wanted = [(n, at, [c.rstrip("\n") for c in row] if n == "open.tsv" else row) for n, at, row in wanted]
    assert got == wanted


def test_seed_names_may_hold_tabs_and_lines(spark, tmp_path):
    (tmp_path / "a.tsv").write_text('Store Name\tURL\tAddress\n"The ""Big""\nShop\there"\twww.big.com\t"1 A St, B"\n  \t \n"No url"\tnone\n', newline="")
    rows = seeds.parse_seeds(seeds.lines(spark, str(tmp_path))).orderBy("line_no").collect()
    assert [(r.line_no, r.store_name, r.store_url is not None, r.ok) for r in rows] == [(1, 'The "Big"\nShop\there', True, True), (4, "No url", False, False)]
    assert list(rows[0].addresses) == ["1 A St, B"]
