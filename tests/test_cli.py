"""The command-line jobs on small text files."""

from conftest import SF_SMALL
from loglens.cli import batch_job, parser, stream_job
from loglens.session import staging_dir
from loglens.sources import access_log_lines, stage_text
from loglens.sources.text import inline


def _file(spark, lines):
    return stage_text(inline(spark, [(v,) for v in lines], "value string").coalesce(1), name="cli")


def _run(spark, *argv):
    return batch_job(spark, parser().parse_args(list(argv)))


def test_word_count_and_longest_line(spark):
    path = _file(spark, ["b a", "a", "ccc a"])
    assert [tuple(r) for r in _run(spark, "word-count", path).collect()] == \
        [("a", 3), ("b", 1), ("ccc", 1)]
    assert tuple(_run(spark, "longest-line", path).first()) == ("ccc a", 5)


def test_filters_sum_concat(spark):
    path = _file(spark, ["one", "two", "three", "four"])
    got = sorted(r.value for r in _run(spark, "member-filter", path, "--keys", "one,two,three").collect())
    assert got == ["one", "three", "two"]
    nums = _file(spark, ["123", "abc", "4", "5"])
    assert sorted(r.value for r in _run(spark, "regex-filter", nums, "--regex", r"\d+").collect()) == \
        ["123", "4", "5"]
    ints = _file(spark, ["1", "2", "3", "4", "5"])
    assert _run(spark, "sum", ints).first()[0] == 15
    words = _file(spark, ["one", "two", "three"])
    assert _run(spark, "concat", words).first()["text"] == "onetwothree"


def test_stream_hits_on_files(spark):
    folder = stage_text(access_log_lines(spark, SF_SMALL), name="cli-stream")
    root = staging_dir(spark, "cli-run")
    args = parser().parse_args(["stream-hits", "--path", folder, "--available-now", "--state-partitions", "4",
                                "--length", "3 days", "--slide", "1 day", "--checkpoint", root])
    stream_job(spark, args)
    from loglens.streaming import read_latest_snapshot
    snap = read_latest_snapshot(spark, f"{root}/snapshots").collect()
    assert len(snap) == 1 and '"key":"dataPush"' in snap[0].message


def test_stream_count_on_files(spark):
    from loglens.streaming import read_batch_counts
    log = access_log_lines(spark, SF_SMALL)
    folder = stage_text(log, name="cli-count")
    root = staging_dir(spark, "cli-count-run")
    stream_job(spark, parser().parse_args(["stream-count", "--path", folder, "--available-now",
                                           "--checkpoint", root]))
    counts = read_batch_counts(spark, f"{root}/out").collect()
    assert sum(r.n for r in counts) == log.count()
