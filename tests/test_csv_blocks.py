"""CSV in blocks against the ``csv`` module over whole files."""

import csv
import io
import json
import random

import pytest

from siltworks.sources import csv_blocks, readers


def whole(data: bytes):
    """(n, row or None) of each row by the csv module; None where it has too many fields."""
    out = []
    for n, row in enumerate(csv.DictReader(io.TextIOWrapper(io.BytesIO(data), encoding="utf-8", newline="")), 1):
        out.append((n, None if row.pop(None, None) is not None else row))
    return out


def read(spark, path):
    rows = readers.read_csv(spark, readers.Source("csv", str(path))).collect()
    return sorted((r["n"], json.loads(r["raw"]) if r["raw"] else None) for r in rows)


@pytest.fixture
def blocks(spark):
    def size(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", n)

    yield size
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def odd(rng, n):
    """Bytes with quotes, separators and line ends anywhere."""
    part = ["a", "bc", '"', '""', ",", "\n", "\r\n", "\r", " ", "é", '"x\ny"', '"p,q"', 'u"v', '"w"z"', "longer text", "\x00"]
    return "".join(rng.choices(part, weights=[6, 6, 1, 1, 5, 3, 2, 1, 2, 2, 1, 1, 1, 1, 4, 0.3], k=n)).encode()


def test_scan_is_the_csv_module_s_state():
    """A line's records and whether it ends inside quotes, as the csv module has them."""
    rng = random.Random(5)
    for _ in range(4000):
        line = odd(rng, rng.randint(0, 12)).replace(b"\n", b"")
        for start, prefix in ((False, b""), (True, b'"')):
            quoted, starts = csv_blocks.scan(line, start)
            assert csv_blocks.after(line, start) == (quoted, starts)
            alone = [r for r in csv_blocks.rows((prefix + line + b"\n").decode()) if r]
            probe = [r for r in csv_blocks.rows((prefix + line + b'\n@@,@@\n').decode()) if r]
            assert quoted == (probe[-1] != ["@@", "@@"])
            assert starts + start == len(alone)


@pytest.mark.parametrize("seed", range(4))
def test_random_files_in_small_blocks(spark, tmp_path, blocks, seed):
    rng = random.Random(seed)
    data = b"k,v,w\n" + odd(rng, 1500) + (b"" if seed % 2 else b"\n")
    if seed > 1:  # mostly one long record: blocks that lie whole inside quotes
        data = b'"k\nk",v\r\n1,"' + b"line\n" * 900 + b'"\n2,b\n' + odd(rng, 300)
    path = tmp_path / "odd.csv"
    path.write_bytes(data)
    blocks(400)
    assert read(spark, path) == whole(data)


def test_one_file_many_tasks(spark, tmp_path, blocks):
    """One file of 60 blocks: as many tasks, none with more than a block and its overhang."""
    rng = random.Random(9)
    out = io.StringIO(newline="")
    w = csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator="\n")
    w.writerow(["id", "text"])
    for i in range(3000):
        w.writerow([i, "".join(rng.choice(['line "q"\n', "word, ", "é "]) for _ in range(rng.randint(0, 12)))])
    data = out.getvalue().encode()
    path = tmp_path / "big.csv"
    path.write_bytes(data)
    blocks(4096)
    sizes = csv_blocks._lines(spark, str(path)).mapInArrow(csv_blocks._states, csv_blocks._STATES).collect()
    assert len(sizes) == -(-len(data) // 4096)
    assert max(r["bytes"] for r in sizes) < 2 * 4096
    assert sum(r["open0"] != r["open1"] for r in sizes) < len(sizes)  # some blocks forget where they started
    assert read(spark, path) == whole(data)


def test_errors_keep_their_rows(spark, tmp_path, blocks, monkeypatch):
    path = tmp_path / "bad.csv"
    blocks(64)
    path.write_bytes(b"a,b\n" + b"1,2\n" * 50 + b"1,2,3\n" + b"1,2\n" * 50 + b'x,"\xff\n"\n' + b"1,2\n" * 50)
    rows = readers.read_csv(spark, readers.Source("csv", str(path)))
    errors = {r["n"]: r["error"] for r in rows.where("error is not null").collect()}
    assert errors.pop(51) == "more fields than the header"
    assert list(errors) == [102] and "0xff" in errors[102]
    assert rows.count() == 152
    monkeypatch.setattr(csv_blocks, "LIMIT", 200)
    path.write_bytes(b'a,b\n1,"' + b"x\n" * 400 + b'"\n2,3\n')
    rows = readers.read_csv(spark, readers.Source("csv", str(path))).orderBy("n").collect()
    assert [(r["n"], r["error"]) for r in rows] == [(1, csv_blocks.TOO_LONG), (2, None)]
    monkeypatch.setattr(csv_blocks, "MOST_BLOCKS", 3)
    with pytest.raises(readers.SourceError, match="maxPartitionBytes"):
        read(spark, path)


def test_headers(spark, tmp_path, blocks):
    path = tmp_path / "h.csv"
    for data in (b"", b"a,b", b"a,b\n", b'"a\n1",b\n1,2\n', b"a,a\n1,2\n", b"\n1,2\n", b"a\r\n1\r\n\r\n2\r\n", b'a\n"open\n', b'a\n"open', b'a\n1\n"open\n\n'):
        path.write_bytes(data)
        assert read(spark, path) == whole(data), data
    path.write_bytes(b'"a\n1",b\n1,2\n')
    assert readers.csv_header(spark, str(path)) == ["a\n1", "b"]
    readers.check_mapping(spark, readers.Source("csv", str(path), readers.Mapping("a\n1", "b")))
    path.write_bytes(b"\xff,b\n1,2\n")
    with pytest.raises(readers.SourceError):
        readers.csv_header(spark, str(path))


def test_several_files(spark, tmp_path, blocks):
    """Files under one path are numbered on in the order of their names, each with its own header."""
    blocks(64)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "b.csv").write_bytes(b"x,y\n" + b'3,"4\n"\n' * 30)
    (tmp_path / "in" / "a.csv").write_bytes(b"y,x\n1,2\n")
    got = read(spark, tmp_path / "in")
    assert got == [(1, {"y": "1", "x": "2"})] + [(i, {"x": "3", "y": "4\n"}) for i in range(2, 32)]
