"""Archives read entry by entry against a plain reading of the same files."""

import bz2
import io
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from tidemark.sources.archives import archive_lines
from tidemark.sources.text import UNREADABLE, read_lines


def test_entries_in_order_and_on_several_tasks(spark, tmp_path):
    """Entries of very different sizes, empty ones, folders, several archives, lines to drop."""
    chance, want = random.Random(3), {}
    for name in ("a b.zip", "c+d%20.zip", "one.zip", "none.zip"):
        lines = []
        with zipfile.ZipFile(tmp_path / name, "w", zipfile.ZIP_DEFLATED) as z:
            for i in range({"one.zip": 1, "none.zip": 0}.get(name, 9)):
                z.mkdir(f"folder{i}")
                own = [f"{name} {i} {j} ü" for j in range(chance.choice([0, 1, 7, 30_000]))]
                z.writestr(f"folder{i}/part", "".join(f"{line}\r\n" for line in own))
                lines += own
        want[name] = lines
    want["e.bzip2"] = [f"{i}" for i in range(25_000)]
    (tmp_path / "e.bzip2").write_bytes(bz2.compress("\n".join(want["e.bzip2"]).encode()))
    df = read_lines(spark, dirs=[str(tmp_path)], drop_first=2)
    got = {}
    for r in df.select(F.substring_index("file", "/", -1).alias("file"), "line_no", "value").orderBy("file", "line_no").collect():
        got.setdefault(r.file, []).append((r.line_no, r.value))
    assert got == {name: list(enumerate(lines[2:])) for name, lines in want.items() if len(lines) > 2}
    assert df.select(F.spark_partition_id()).distinct().count() > 1


def test_faults_cost_their_entry_only(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_STORED) as z:
        for i in range(3):
            z.writestr(f"{i}", f"first {i}\nsecond {i}\n")
    data = bytearray((tmp_path / "a.zip").read_bytes())
    at = data.index(b"second 1")
    data[at:at + 6] = b"broken"
    (tmp_path / "a.zip").write_bytes(data)
    rows = [r.value for r in read_lines(spark, [str(tmp_path / "a.zip")]).orderBy("line_no").collect()]
    assert rows[:2] == ["first 0", "second 0"] and rows[-2:] == ["first 2", "second 2"]
    assert sum(v.startswith(UNREADABLE) for v in rows) == 1


def test_own_opener_and_trouble_in_reaching(spark, tmp_path):
    content = bz2.compress(b"x\ny\n")
    (tmp_path / "a.bzip2").write_bytes(b"elsewhere")
    rows = read_lines(spark, [str(tmp_path / "a.bzip2")], open_archive=lambda path: io.BytesIO(content)).orderBy("line_no").collect()
    assert [r.value for r in rows] == ["x", "y"]
    gone = spark.createDataFrame([(f"file:{tmp_path}/gone.zip",)], "file string")
    with pytest.raises(Exception, match="gone.zip"):
        archive_lines(gone).collect()
    assert archive_lines(gone.limit(0)).count() == 0
