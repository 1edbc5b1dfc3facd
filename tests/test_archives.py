"""Archives of frames against their whole text."""

from __future__ import annotations

import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from rentscope.registry import fixtures as fx
from rentscope.sources import archives


def packed(pieces, **settings):
    """Each piece as a frame."""
    return b"".join(zstandard.ZstdCompressor(**settings).compress(p) for p in pieces)


def read_all(path, split_bytes):
    runs = archives.runs_of(str(path), path.stat().st_size, split_bytes)
    return [line for run in runs for piece in archives.lines_of(run) for line in piece], runs


TEXT = st.lists(st.sampled_from([b"a", b"bcd", b"\n", b"\n\n", b"", b"x" * 300, b"\r\n"]), max_size=25).map(b"".join)


@settings(max_examples=200, deadline=None)
@given(TEXT, st.lists(st.integers(0, 400), max_size=6), st.integers(1, 120), st.booleans(), st.booleans())
def test_lines_are_whole_wherever_frames_are_cut(tmp_path_factory, text, cuts, split, sized, checked):
    """Frames end anywhere, also within a line that spans several of them, and some are empty."""
    bounds = sorted({0, len(text), *(min(c, len(text)) for c in cuts)})
    pieces = [text[a:b] for a, b in zip(bounds, bounds[1:], strict=False)] + [b""]
    path = tmp_path_factory.mktemp("a") / "a.zst"
    skippable = (0x184D2A53).to_bytes(4, "little") + (3).to_bytes(4, "little") + b"xyz"
    path.write_bytes(skippable + packed(pieces[:2], write_content_size=sized, write_checksum=checked) + skippable + packed(pieces[2:], write_checksum=checked))
    expected = text.split(b"\n")
    if expected[-1] == b"":
        expected.pop()
    for size in (split, 1 << 30):
        assert read_all(path, size)[0] == expected


def test_frames_of_many_blocks(tmp_path):
    """Compressed, raw and repeated blocks of large frames."""
    import os

    pieces = [os.urandom(400_000).replace(b"\n", b"."), b"\n" + b"z" * 700_000 + b"\n", b"".join(b"line %d\n" % i for i in range(100_000))]
    path = tmp_path / "a.zst"
    path.write_bytes(packed(pieces))
    lines, runs = read_all(path, 1)
    assert lines == b"".join(pieces).split(b"\n")[:-1] and len(runs) == 3


def test_one_archive_is_read_by_several_tasks(spark, tmp_path):
    lines = [f"line {i} ä" for i in range(5000)]
    archives.write_frames((f"{x}\r\n".encode() for x in lines), str(tmp_path / "big.tsv.zst"), 4_000)
    (tmp_path / "one.tsv.zst").write_bytes(packed(["\n".join(lines[:7]).encode() + b"\n\xff"]))
    (tmp_path / "other.txt").write_text("not read")
    df = archives.read_lines(spark, str(tmp_path / "*.zst"), 1_000)
    assert df.rdd.getNumPartitions() > 5
    by_file: dict = {}
    for r in df.orderBy("file", "seq").collect():
        by_file.setdefault(r.file.rsplit("/", 1)[1], []).append(r.value)
    assert by_file == {"big.tsv.zst": lines, "one.tsv.zst": [*lines[:7], "�"]}
    assert df.select("file", "seq").distinct().count() == df.count()


def test_archives_are_rewritten_into_frames(spark, tmp_path):
    text = "".join(f"row {i}\n" for i in range(3000))
    for name, body in (("a.zst", text), ("b.zst", ""), ("c.zst", "no end")):
        (tmp_path / name).write_bytes(packed([body.encode()]))
    made = {r.file.rsplit("/", 1)[1]: r for r in archives.reframe(spark, str(tmp_path / "*.zst"), str(tmp_path / "out"), 2_000).collect()}
    assert made["a.zst"].n_frames > 5 and made["b.zst"].n_frames == 0 and made["c.zst"].n_frames == 1
    read = archives.read_lines(spark, str(tmp_path / "out" / "*.zst"), 500)
    assert [r.value for r in read.filter("file LIKE '%a.zst'").orderBy("seq").collect()] == text.splitlines()
    assert [r.value for r in read.filter("file LIKE '%c.zst'").collect()] == ["no end"]


def test_nothing_and_broken_archives(spark, tmp_path):
    assert archives.read_lines(spark, str(tmp_path / "*.zst")).collect() == []
    assert archives.reframe(spark, str(tmp_path / "*.zst"), str(tmp_path / "out")).collect() == []
    whole = packed([b"line\n" * 5000])
    for body in (b"no archive", whole[:-3], whole + b"\x28"):
        (tmp_path / "bad.zst").write_bytes(body)
        with pytest.raises(ValueError, match="byte|frame"):
            read_all(tmp_path / "bad.zst", 100)


def test_made_archives_have_several_runs(spark, medium_dir):
    pattern = fx.spot_archives(spark, medium_dir)
    files = archives.list_files(spark, pattern)
    runs = [len(archives.runs_of(path, size, fx.ARCHIVE_SPLIT)) for path, size in files]
    assert len(files) == 4 and min(runs) == 1 and max(runs) > 3


def test_many_small_frames_make_few_partitions(spark, tmp_path):
    """Tasks follow the cores, not the frames, and all lines come once."""
    n = archives.write_frames((b"line %d\n" % i for i in range(60_000)), str(tmp_path / "a.zst"), 200)
    df = archives.read_lines(spark, str(tmp_path / "*.zst"), 50)
    most = 2 * archives.RUNS_A_CORE * spark.sparkContext.defaultParallelism
    assert n > 10 * most and df.rdd.getNumPartitions() <= most
    assert [r.value for r in df.orderBy("seq").collect()] == [f"line {i}" for i in range(60_000)]
    assert archives.split_for([1 << 40], 1, 8) == archives.SPLIT_BYTES and archives.split_for([10], 50, 8) == 50


def test_the_end_of_a_line_is_read_in_small_steps(tmp_path):
    path = tmp_path / "a.zst"
    path.write_bytes(packed([b"one\ntw", b"o\n", *[b"more\n"] * 5_000]))
    read = []

    class Counted:
        def __init__(self, file):
            self.seek, self.file = file.seek, file

        def read(self, n):
            read.append(n)
            return self.file.read(n)

    run = archives.runs_of(str(path), path.stat().st_size, 1)[0]
    with path.open("rb") as file:
        assert next(archives._text(Counted(file), run.end, run.size, archives.FIRST_READ)).startswith(b"o\nmore")
    assert read == [archives.FIRST_READ] and [line for piece in archives.lines_of(run) for line in piece] == [b"one", b"two"]


def test_a_large_frame_is_written_in_pieces(tmp_path, monkeypatch):
    monkeypatch.setattr(archives, "WRITE_BYTES", 1_000)
    lines = [b"row %d\n" % i for i in range(5_000)]
    for frame_bytes, expected in ((1 << 40, 1), (20_000, None), (100, None)):
        path = tmp_path / f"{frame_bytes}.zst"
        n = archives.write_frames(iter(lines), str(path), frame_bytes)
        found, runs = read_all(path, 1)
        assert found == [line[:-1] for line in lines] and len(runs) == n == (expected or n)
    assert archives.write_frames(iter([]), str(tmp_path / "none.zst")) == 0
