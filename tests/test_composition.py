"""Normal form C as expressions against ``unicodedata``."""

import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from siltworks.functions import composition, text as tx

STARTERS = [*"aeoucAEKZ<=>\n \"", *map(chr, (0x1100, 0x1112, 0x1161, 0x1175, 0x11A8, 0x11C2, 0xAC00, 0xAC1C, 0x9C7, 0x9BE, 0x9D7, 0x1F71, 0x212B, 0x2126, 0xFB1D, 0xFB2C, 0x1D15E, 0xF900, 0x3B1, 0x345, 0xDC7, 0xDD9, 0xDCA, 0x1025, 0x102E, 0x30AB, 0x3099, 0x1E0A, 0x1E09, 0xE7, 0x11131, 0x11127))]


def nfc(text):
    return unicodedata.normalize("NFC", text)


def test_every_code_point(spark):
    """Alone, and after a letter; what is not touched is in normal form."""
    points = [chr(p) for p in range(1, 0x110000) if not 0xD800 <= p < 0xE000 and (p < 0x32000 or p > 0xE0000)]
    rows = ["".join(c + between for c in points[i : i + 1000]) for i in range(0, len(points), 1000) for between in (" ", "a")]
    got = spark.createDataFrame(list(enumerate(rows)), "i int, t string").repartition(8).select("i", composition.composed(F.col("t")).alias("c"), composition.touched(F.col("t")).alias("m")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["c"] == nfc(rows[r["i"]])
        assert r["m"] or r["c"] == rows[r["i"]]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_runs_of_marks(spark, seed):
    rng = random.Random(seed)
    marks, common = [*composition.tables().order], [chr(x) for x in range(0x300, 0x345)]
    pick = lambda: rng.choice(STARTERS) if rng.random() < 0.4 else rng.choice(common if rng.random() < 0.7 else marks)
    rows = ["".join(pick() for _ in range(rng.randint(0, 30))) for _ in range(600)] + ["e" + "̣́" * 200, "á " * 300, "", "plain", "Съешь же", "漢字", "“naïve”—"]
    df = spark.createDataFrame(list(enumerate(rows)), "i int, t string").repartition(8)
    got = df.select("i", composition.composed(F.col("t")).alias("c"), tx.nfc(F.col("t")).alias("n"), composition.touched(F.col("t")).alias("x")).collect()
    for r in got:
        want = nfc(rows[r["i"]])
        assert r["n"] == want
        assert r["i"] >= 600 or r["c"] == want
        assert r["x"] or rows[r["i"]] == want
    plain = {rows[r["i"]]: r["x"] for r in got}
    assert not plain["Съешь же"] and not plain["漢字"] and not plain["“naïve”—"]  # other scripts and signs are not touched
    assert spark.createDataFrame([(None,)], "t string").select(tx.nfc(F.col("t"))).first()[0] is None
