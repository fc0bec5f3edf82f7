from __future__ import annotations

import os
import random
from collections import Counter
from datetime import date, datetime

import pytest

from clickloom.operators import ads, sliding
from clickloom.sources.adlog import file_lines, parse_ad_log
from clickloom.streaming.ads import ArrivalStream, ClickStream, late_clicks, start_running_stat, start_sliding, start_trend
from clickloom.streaming.state import last_batch
from frames import lines, log_line

DAY = date(2024, 3, 1)
TREND_COLUMNS = ("hour", "minute", "ad_id", "click_count")


def _line(user, ad=1, hour=1, day=1, minute=0, province="p_1", city="c_1"):
    return log_line(datetime(2024, 3, day, hour, minute), province, city, user, ad)


def _write(folder, name, texts, at):
    """A log file with a set modification time, so that files are taken in order."""
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(t + "\n" for t in texts))
    os.utime(folder / name, (at, at))


def _finish(query):
    query.awaitTermination()
    assert query.exception() is None


def _model(batches, threshold):
    """The feedback loop in plain Python: batches of (day, province, city, user, ad)."""
    users, cities, banned = Counter(), Counter(), set()
    for batch in batches:
        kept = [c for c in batch if c[3] not in banned]
        for day, province, city, user, ad in kept:
            users[day, user, ad] += 1
            cities[day, province, city, ad] += 1
        banned |= {user for (_, user, _), n in users.items() if n >= threshold}
    return {
        "ad_user_click_count": sorted(((date(2024, 3, d), u, a, n) for (d, u, a), n in users.items()), key=str),
        "ad_stat": sorted(((date(2024, 3, d), p, c, a, n) for (d, p, c, a), n in cities.items()), key=str),
        "ad_blacklist": sorted(((u,) for u in banned), key=str),
    }


def _random_batches(n, seed=161):
    rng = random.Random(seed)
    return [
        [(rng.choice([1, 1, 1, 2]), f"p_{rng.randrange(2)}", "c", rng.choice([0, 0, 1, 2, 3]), rng.randrange(3))]
        * rng.randrange(1, 4)
        + [(1 + i % 2, "p_0", "d", rng.randrange(9), rng.randrange(4)) for i in range(rng.randrange(12))]
        for _ in range(n)
    ]


def _clicks(spark, batch):
    return parse_ad_log(lines(spark, *(_line(u, a, day=d, province=p, city=c) for d, p, c, u, a in batch)))


def _tables(stream, last, rows):
    return {
        "ad_user_click_count": rows(stream.user_counts.totals(last)),
        "ad_stat": rows(stream.city_counts.totals(last)),
        "ad_blacklist": rows(stream.banned.after(last)),
    }


@pytest.mark.parametrize(("fold_every", "seed"), [(64, 26), (2, 26), (3, 108)])
def test_batches_follow_the_model_with_and_without_folding(spark, rows, tmp_path, fold_every, seed):
    batches = _random_batches(5, seed)
    stream = ClickStream(spark, str(tmp_path), threshold=3, fold_every=fold_every)
    for i, batch in enumerate(batches):
        stream.process(_clicks(spark, batch), i)
        if i >= 2:
            assert _tables(stream, i, rows) == _model(batches[: i + 1], 3)
    assert _model(batches[:3], 3)["ad_blacklist"]


def test_a_batch_is_finished_when_all_its_tables_are_written(spark, tmp_path, monkeypatch):
    stream = ClickStream(spark, str(tmp_path), threshold=3)
    for i, batch in enumerate(_random_batches(4)):
        stream.process(_clicks(spark, batch), i)
        assert last_batch(spark, str(tmp_path)) == i
    assert len([p for p in (tmp_path / "finished").iterdir() if p.name.isdigit()]) == 2

    def fails(*_):
        raise OSError

    monkeypatch.setattr(stream.banned, "write", fails)
    with pytest.raises(OSError):
        stream.process(_clicks(spark, batch), 4)
    assert last_batch(spark, str(tmp_path)) == 3


def test_a_batch_that_runs_again_changes_nothing(spark, rows, tmp_path):
    batches = _random_batches(5)
    stream = ClickStream(spark, str(tmp_path), threshold=3, fold_every=2)
    for i, batch in enumerate(batches):
        for _ in range(2):  # as after a failure before the commit, also where a fold has been done
            stream.process(_clicks(spark, batch), i)
    assert _tables(stream, 4, rows) == _model(batches, 3)


def test_what_is_folded_is_deleted_and_folders_stay_few(spark, rows, tmp_path):
    batches = _random_batches(13)
    stream = ClickStream(spark, str(tmp_path), threshold=3, fold_every=2)
    for i, batch in enumerate(batches):
        stream.process(_clicks(spark, batch), i)
        if i in (8, 12):
            stream.process(_clicks(spark, batch), i)  # a retry of the batch that has folded and deleted
        for table in ("ad_stat", "ad_user_click_count", "ad_blacklist"):
            assert len(list((tmp_path / table / "batches").iterdir())) <= 4
        parts = {p.name for p in (tmp_path / "ad_stat").glob("folded1/date=*/upto=*")}
        assert len(parts) <= 4
    assert _tables(stream, 12, rows) == _model(batches, 3)
    assert len(list((tmp_path / "ad_blacklist" / "folded").iterdir())) <= 2
    one = rows(stream.city_counts.totals(12, dates=["2024-03-02"]))
    assert one == [r for r in rows(stream.city_counts.totals(12)) if r[0] == date(2024, 3, 2)]


def test_clicks_of_the_crossing_batch_count_and_later_ones_do_not(spark, rows, tmp_path):
    log, root = tmp_path / "log", str(tmp_path / "state")
    _write(log, "1.txt", [_line(7)] * 3 + [_line(8)] * 2, 1000)
    _write(log, "2.txt", [_line(7)] * 4 + [_line(7, ad=2)] + [_line(8)], 2000)
    _write(log, "3.txt", [_line(7)] * 5 + [_line(7, ad=2, day=2)] + [_line(8, day=2)] * 2, 3000)
    stream = ClickStream(spark, root, threshold=5)
    _finish(stream.start(parse_ad_log(file_lines(spark, str(log), maxFilesPerTrigger="1")), available_now=True))
    assert last_batch(spark, root) == 2
    got = {name: rows(df) for name, df in stream.tables().items()}
    assert got["ad_blacklist"] == [(7,)]
    assert got["ad_user_click_count"] == [
        (DAY, 7, 1, 7),
        (DAY, 7, 2, 1),
        (DAY, 8, 1, 3),
        (date(2024, 3, 2), 8, 1, 2),
    ]
    assert got["ad_stat"] == [
        (DAY, "p_1", "c_1", 1, 10),
        (DAY, "p_1", "c_1", 2, 1),
        (date(2024, 3, 2), "p_1", "c_1", 1, 2),
    ]
    assert got["ad_province_top3"] == [
        (DAY, "p_1", 1, 10),
        (DAY, "p_1", 2, 1),
        (date(2024, 3, 2), "p_1", 1, 2),
    ]


def test_a_restarted_stream_goes_on_and_unreadable_batches_do_no_harm(spark, rows, tmp_path):
    log, root = tmp_path / "log", str(tmp_path / "state")

    def run():
        stream = ClickStream(spark, root, threshold=3)
        _finish(stream.start(parse_ad_log(file_lines(spark, str(log))), available_now=True))
        return {name: rows(df) for name, df in stream.tables().items()}

    _write(log, "1.txt", [_line(1)] * 2, 1000)
    run()
    _write(log, "2.txt", ["no click in here"], 2000)
    run()
    _write(log, "3.txt", [_line(1)] * 2 + [_line(2, ad=9)], 3000)
    assert run()["ad_blacklist"] == [(1,)]
    _write(log, "4.txt", [_line(1)] * 2 + [_line(2, ad=9)], 4000)
    got = run()
    assert got["ad_user_click_count"] == [(DAY, 1, 1, 4), (DAY, 2, 9, 2)]


def test_no_table_before_the_first_batch(spark, tmp_path):
    with pytest.raises(LookupError):
        ClickStream(spark, str(tmp_path)).tables()


@pytest.fixture
def three_files(tmp_path):
    log = tmp_path / "log"
    _write(log, "1.txt", [_line(u, u % 2, hour=5) for u in range(5)], 1000)
    _write(log, "2.txt", [_line(u, u % 2, hour=9, minute=u) for u in range(5)], 2000)
    _write(log, "3.txt", [_line(u, u % 2, hour=5) for u in range(3)] + [_line(1, 1, hour=9, minute=1)], 3000)
    return str(log)


def _all_clicks(spark, log):
    return parse_ad_log(spark.read.text(log).withColumnRenamed("value", "line"))


def test_trend_counts_late_clicks(spark, rows, three_files, tmp_path):
    clicks = parse_ad_log(file_lines(spark, three_files, maxFilesPerTrigger="1"))
    stream, query = start_trend(spark, clicks, str(tmp_path / "state"), available_now=True)
    _finish(query)
    assert rows(stream.table()) == rows(ads.minute_click_counts(_all_clicks(spark, three_files)))


def test_trend_with_a_watermark_drops_late_clicks(spark, rows, three_files, tmp_path):
    # The mark rises after the second file and holds for late clicks from the batch after the third on.
    _write(tmp_path / "log", "4.txt", [_line(2, 0, hour=5), _line(2, 0, hour=9, minute=30)], 4000)
    clicks = parse_ad_log(file_lines(spark, three_files, maxFilesPerTrigger="1"))
    stream, query = start_trend(spark, clicks, str(tmp_path / "state"), watermark="1 hour", available_now=True)
    _finish(query)
    got = rows(stream.table(), *TREND_COLUMNS)
    assert ("05", "00", 0, 5) in got and ("09", "30", 0, 1) in got
    assert ("05", "00", 0, 6) in rows(ads.minute_click_counts(_all_clicks(spark, three_files)), *TREND_COLUMNS)


def test_a_live_stream_works_at_its_interval(spark, rows, three_files, tmp_path):
    stream = ClickStream(spark, str(tmp_path / "state"))
    query = stream.start(parse_ad_log(file_lines(spark, three_files)))
    query.processAllAvailable()
    query.stop()
    assert rows(stream.tables()["ad_stat"]) == rows(ads.city_click_counts(_all_clicks(spark, three_files)))


def test_running_stat_equals_batch(spark, rows, three_files, tmp_path):
    clicks = parse_ad_log(file_lines(spark, three_files, maxFilesPerTrigger="1"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    stream, query = start_running_stat(spark, clicks, str(tmp_path / "state"), available_now=True, partitions=3)
    _finish(query)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert '"spark.sql.shuffle.partitions":"3"' in (tmp_path / "state" / "checkpoint" / "offsets" / "0").read_text()
    expected = rows(ads.city_click_counts(_all_clicks(spark, three_files)))
    assert rows(stream.table()) == expected
    files = [f for f in os.listdir(tmp_path / "state" / "ad_stat" / "batches" / "0") if f.endswith(".parquet")]
    assert len(files) == 1  # few rows make one file, however many partitions the state has


def test_running_stat_with_a_watermark_drops_clicks_of_old_days(spark, rows, tmp_path):
    log = tmp_path / "log"
    _write(log, "1.txt", [_line(1, day=1)] * 2, 1000)
    _write(log, "2.txt", [_line(1, day=9)], 2000)
    _write(log, "3.txt", [_line(1, day=9)], 3000)
    _write(log, "4.txt", [_line(1, day=1), _line(1, day=8)], 4000)
    clicks = parse_ad_log(file_lines(spark, str(log), maxFilesPerTrigger="1"))
    stream, query = start_running_stat(spark, clicks, str(tmp_path / "state"), watermark="2 days", available_now=True)
    _finish(query)
    assert [(r[0].day, r[-1]) for r in rows(stream.table())] == [(1, 2), (8, 1), (9, 2)]


def test_an_unreached_threshold_gives_the_plain_counts(spark, rows, three_files, tmp_path):
    clicks = parse_ad_log(file_lines(spark, three_files, maxFilesPerTrigger="1"))
    stream = ClickStream(spark, str(tmp_path / "state"))
    _finish(stream.start(clicks, available_now=True))
    assert rows(stream.tables()["ad_stat"]) == rows(ads.city_click_counts(_all_clicks(spark, three_files)))
    assert rows(stream.tables()["ad_blacklist"]) == []


def _stored_top(stream, rows):
    return rows(stream.top_ads.read(stream.spark, "ad_province_top3"))


@pytest.mark.parametrize("fold_every", [64, 2])
def test_the_stored_top_ads_equal_the_ranked_counts_after_each_batch(spark, rows, tmp_path, fold_every):
    stream = ClickStream(spark, str(tmp_path), threshold=4, fold_every=fold_every)
    for i, batch in enumerate(_random_batches(4, 77)):
        for _ in range(1 + i % 2):  # some batches run twice
            stream.process(_clicks(spark, batch), i)
        ranked = ads.province_top_ads(ads.province_click_counts(stream.city_counts.totals(i)))
        assert _stored_top(stream, rows) == rows(ranked.select("date", "province", "ad_id", "click_count"))
    assert rows(stream.tables(["2024-03-02"])["ad_province_top3"]) == [r for r in _stored_top(stream, rows) if r[0] == date(2024, 3, 2)]


def test_only_the_groups_of_a_batch_are_ranked_again(spark, tmp_path):
    stream = ClickStream(spark, str(tmp_path))
    stream.process(_clicks(spark, [(1, "p_1", "c", 1, 1), (1, "p_2", "c", 1, 1), (2, "p_1", "c", 1, 1)]), 0)
    folder = tmp_path / "ranked" / "ad_province_top3"
    written = lambda: {str(f.relative_to(folder).parent): f.stat().st_mtime_ns for f in folder.rglob("*.parquet")}
    before = written()
    stream.process(_clicks(spark, [(1, "p_2", "c", 2, 3)]), 1)
    changed = {group for group, at in written().items() if at != before.get(group)}
    assert changed == {"date=2024-03-01/province=p_2"}


def test_late_clicks_are_accounted_for(spark, rows, tmp_path):
    log = tmp_path / "log"
    slices = [[_line(1, hour=1), _line(1, hour=5)], [_line(1, hour=4), _line(2, hour=1), _line(3, hour=1, ad=2), _line(1, hour=9)], [_line(5, hour=1)]]
    for i, texts in enumerate(slices):
        _write(log, f"{i}.txt", texts, 1000 + i)
        clicks = parse_ad_log(file_lines(spark, str(log)))
        trend, query = start_trend(spark, clicks, str(tmp_path / "trend"), watermark="2 hours", available_now=True)
        _finish(query)
        arrivals = ArrivalStream(spark, str(tmp_path / "arrivals"))
        _finish(arrivals.start(clicks, available_now=True))
    # minutes that ended two hours before the latest click have left the state
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] == 1
    assert [(r.arrived, r.counted, r.late) for r in late_clicks(arrivals.table(), trend.table()).collect()] == [(7, 4, 3)]
    arrivals.process(parse_ad_log(lines(spark, *slices[2])), last_batch(spark, arrivals.root))
    assert [(r.arrived, r.late) for r in late_clicks(arrivals.table(), trend.table()).collect()] == [(7, 3)]


def test_the_sliding_stream_equals_batch(spark, rows, three_files, tmp_path):
    clicks = parse_ad_log(file_lines(spark, str(three_files), maxFilesPerTrigger="1"))
    stream, query = start_sliding(spark, clicks, str(tmp_path / "s"), available_now=True)
    _finish(query)
    batch = parse_ad_log(spark.read.text(str(three_files)).withColumnRenamed("value", "line"))
    assert rows(sliding.sliding_click_counts(stream.table())) == rows(sliding.sliding_click_counts(sliding.pane_click_counts(batch)))
