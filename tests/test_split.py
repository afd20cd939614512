"""Arrays cut into records over byte ranges equal arrays read whole."""

import json
import random

import pytest

from ticktide.schemas import POST
from ticktide.sources import files

TRICKY = ['', '}', '{"a":[1,{', '"}"', "\\", '\\"}', ']} , {"', "é…東京}", 'line\nbreak}', '\\\\"', "[[[", "tab\t}"]


def post(rng, number):
    comments = [{"comm_id": f"c{at}", "comm_body": rng.choice(TRICKY) + rng.choice(TRICKY), "comm_time_utc": 1.5 * at, "comm_score": at}
                for at in range(rng.randrange(4))]
    return {"post_id": f"p{number}", "post_title": rng.choice(TRICKY) + " title " + rng.choice(TRICKY), "post_time": 1.0,
            "post_score": number, "post_upvote": 0.5, "comments": comments}


def written(root, seed):
    rng = random.Random(seed)
    for hour in range(5):
        folder = root / f"hour=2024-01-01-{hour:02}"
        folder.mkdir(parents=True)
        rows = [post(rng, 100 * hour + at) for at in range((0, 1, 3, 12, 25)[hour])]
        for form, style in (("a", dict(indent=2)), ("b", dict(separators=(",", ":"))), ("c", dict(ensure_ascii=False, indent=None))):
            (folder / f"{form}.json").write_text(json.dumps(rows, **style) + rng.choice(["", "\n", " \n\n"]))


@pytest.mark.parametrize("size", ["64", str(64 << 20)])
def test_ranges_of_any_size_give_the_same_records(spark, tmp_path, size):
    written(tmp_path, 7)
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        split = files.read_split_posts(spark, str(tmp_path), partitions=["hour"])
        assert size != "64" or split.sparkSession.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions() > 50
        got = [tuple(row) for row in files.good_posts(split).select("hour", *[f for f in POST.fieldNames() if f != "part"]).collect()]
        assert files.bad_records(split).count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    whole = files.good_posts(files.read_posts(spark, str(tmp_path), multi_line=True, partitions=["hour"]))
    expected = [tuple(row) for row in whole.select("hour", *[f for f in POST.fieldNames() if f != "part"]).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, expected)) and len(got) == 3 * 41


def test_what_is_broken_is_set_aside(spark, tmp_path):
    good = [post(random.Random(1), at) for at in range(6)]
    (tmp_path / "a.json").write_text(json.dumps(good)[:-40])
    (tmp_path / "b.json").write_text('[{"post_id": 5, "post_title": "x", "post_score": "?"}, {"post_id": "q"}]')
    (tmp_path / "c.json").write_text("[]")
    (tmp_path / "d.json").write_text("not json")
    rows = files.read_split_posts(spark, str(tmp_path))
    ids = {row.post_id for row in files.good_posts(rows).collect()}
    assert {"p0", "p1", "p2", "p3", "p4", "q"} <= ids and "p5" not in ids
    assert files.bad_records(rows).count() == 3
