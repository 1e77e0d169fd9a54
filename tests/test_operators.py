import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.operators import hierarchy, merge, ordered, search
from millrace.plans import alerts, measurements, monitoring, reports, texts
from millrace.session import fresh_path, pin

FEW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def test_station_summary_rounds_half_away_from_zero(spark, as_rows):
    data = [("a", "0.2"), ("a", "0.3"), ("b", "-0.2"), ("b", "-0.3"), ("c", "9.9")]
    df = spark.createDataFrame(data, "station_name string, measurement string")
    df = df.withColumn("measurement", F.col("measurement").cast("decimal(3,1)"))
    summary = measurements.station_summary(df)
    assert [(r[0], str(r[2])) for r in summary.collect()] == [("a", "0.3"), ("b", "-0.3"), ("c", "9.9")]
    line = measurements.summary_line(summary).first()["result"]
    assert line == "{a=0.2/0.3/0.3, b=-0.3/-0.3/-0.2, c=9.9/9.9/9.9}"


def test_global_ordinal_is_dense_and_ordered(spark):
    df = spark.range(3000).select((F.hash("id") % 50).alias("k"), "id").repartition(6)
    got = [(r["k"], r["id"]) for r in ordered.global_ordinal(df, ["k", "id"], "n").orderBy("n").collect()]
    assert got == sorted((r["k"], r["id"]) for r in df.collect())
    ns = ordered.global_ordinal(df, ["k", "id"], "n").agg(F.min("n"), F.max("n"), F.count_distinct("n")).first()
    assert ns[:] == (1, 3000, 3000)


@FEW
@given(st.lists(st.tuples(st.integers(0, 2), st.one_of(st.none(), st.integers(-50, 50))), min_size=1, max_size=60), st.booleans())
def test_chunked_windows_equal_plain_windows(spark, items, keyed):
    data = [(k, i, v) for i, (k, v) in enumerate(items)]
    df = spark.createDataFrame(data, "k int, i bigint, v int")
    keys = ["k"] if keyed else []
    lag = {r["i"]: r["prev_v"] for r in ordered.with_previous(df, keys, "i", ["v"]).collect()}
    sums = {r["i"]: r["s"] for r in ordered.running_sum(df, keys, ["i"], F.col("v"), "s").collect()}
    tops = {r["i"]: r["m"] for r in ordered.running_max(df, keys, ["i"], "v", "m").collect()}
    assert len(lag) == len(sums) == len(tops) == len(data)
    for k, i, _ in data:
        past = [v for kk, ii, v in data if (kk == k or not keyed) and ii <= i]
        known = [v for v in past if v is not None]
        assert lag[i] == (past[-2] if len(past) > 1 else None)
        assert sums[i] == (sum(known) if known else None)
        assert tops[i] == (max(known) if known else None)


@pytest.mark.parametrize("keys", [["k"], []])
def test_hot_key_is_split_over_chunks(spark, plan_of, keys):
    df = spark.range(1000).select(F.lit(1).alias("k"), "id")
    assert ordered.chunked(df, keys, ["id"]).select("_chunk").distinct().count() > 1
    out = ordered.running_sum(df, keys, ["id"], F.col("id"), "s")
    assert "SinglePartition" not in plan_of(out)
    assert {r["id"]: r["s"] for r in out.collect()} == {i: i * (i + 1) // 2 for i in range(1000)}


def visible_by_force(grid):
    height, width = len(grid), len(grid[0])

    def seen(y, x):
        t = grid[y][x]
        sides = [[grid[j][x] for j in range(y)], [grid[j][x] for j in range(y + 1, height)], grid[y][:x], grid[y][x + 1:]]
        return any(all(t > o for o in side) for side in sides)

    return {(x, y) for y in range(height) for x in range(width) if seen(y, x)}


@pytest.mark.parametrize("tile", [1, 2, 3, 100])
def test_grid_visibility_equals_brute_force(spark, tile):
    pick = random.Random(tile)
    grid = [[pick.randint(0, 9) for _ in range(7)] for _ in range(9)]
    cells = spark.createDataFrame([(x, y, t) for y, row in enumerate(grid) for x, t in enumerate(row)], "x int, y int, tree int")
    got = {(r["x"], r["y"]) for r in ordered.grid_visibility(cells, tile=tile).where("visible").collect()}
    assert got == visible_by_force(grid)


def test_island_sums(spark, as_rows):
    data = [(1, "1000"), (2, "2000"), (3, None), (4, "500")]
    df = spark.createDataFrame(data, "id bigint, calories string").withColumn("c", F.col("calories").cast("bigint"))
    out = ordered.island_sums(df, "id", F.col("calories").isNull(), "c")
    assert as_rows(out, "total") == [(3000,), (500,)]


def test_pages(spark):
    pages = ordered.chunked_pages(spark.range(25).select("id", (F.col("id") * 2).alias("v")), ["id"], 10, ["id", "v"])
    got = {r["page"]: (r["id"], r["v"]) for r in pages.collect()}
    assert [len(got[p][0]) for p in (0, 1, 2)] == [10, 10, 5]
    assert got[1][0] == list(range(10, 20)) and got[2][1] == [2 * i for i in range(20, 25)]


def test_asof_latest(spark, as_rows):
    left = spark.createDataFrame([("a", 5, "x"), ("a", 1, "y"), ("b", 9, "z")], "k string, t int, id string")
    right = spark.createDataFrame([("a", 2, 20), ("a", 5, 50), ("a", 7, 70)], "k string, t int, v int")
    out = ordered.asof_latest(left, right, ["k"], "t", ["v"])
    assert as_rows(out, "id", "last_t", "last_v") == [("x", 5, 50), ("y", None, None), ("z", None, None)]


def test_deep_chain_has_no_limit(spark):
    df = spark.range(3000).select(F.col("id").cast("string").alias("name"), F.when(F.col("id") > 0, (F.col("id") - 1).cast("string")).alias("parent"))
    deepest = hierarchy.hierarchy_paths(df, "name", "parent").where("name = '2999'").first()["path"]
    assert deepest == "".join(f"/{k}" for k in range(2999))


FILES = [
    ("Folder_A", None, None), ("Folder_A_1", "Folder_A", None), ("Folder_B", "Folder_A", None),
    ("Folder_A_2", "Folder_A", None), ("Folder_B_1", "Folder_B", None), ("File_A1.txt", "Folder_A", 1234),
    ("File_A2.txt", "Folder_A", 6789), ("File_B1.txt", "Folder_B", 4567),
]


def test_hierarchy_walk_and_paths(spark, as_rows):
    df = spark.createDataFrame(FILES, "name string, parent string, size bigint")
    walked = hierarchy.walk_hierarchy(df, "name", "parent")
    assert as_rows(walked, "name", "parent", "size") == as_rows(df)
    assert dict(as_rows(walked, "name", "depth"))["File_B1.txt"] == 2
    paths = dict(as_rows(hierarchy.hierarchy_paths(df, "name", "parent"), "name", "path"))
    assert paths["Folder_A"] == "" and paths["Folder_B"] == "/Folder_A" and paths["File_B1.txt"] == "/Folder_A/Folder_B"
    back = dict(as_rows(hierarchy.hierarchy_paths(df, "name", "parent", sep="\\"), "name", "path"))
    assert back["Folder_B_1"] == "\\Folder_A\\Folder_B"


def test_hierarchy_with_cycle(spark, as_rows):
    data = [("r", None), ("a", "r"), ("b", "a"), ("a", "b"), ("x", "y"), ("y", "x")]
    df = spark.createDataFrame(data, "name string, parent string")
    walked = hierarchy.walk_hierarchy(df, "name", "parent")
    assert as_rows(walked, "name", "parent") == sorted([("r", None), ("a", "r"), ("b", "a"), ("a", "b")], key=repr)
    with pytest.raises(RecursionError):
        hierarchy.hierarchy_paths(df, "name", "parent")


TRANSCRIPT = """$ cd /
$ ls
dir a
14848514 b.txt
8504156 c.dat
dir d
$ cd a
$ ls
dir e
29116 f
2557 g
62596 h.lst
$ cd e
$ ls
584 i
$ cd ..
$ cd ..
$ cd d
$ ls
4060174 j
8033020 d.log
5626152 d.ext
7214296 k""".splitlines()


def test_transcript_sizes(spark):
    data = [(s, i, line) for s in ("s1", "s2") for i, line in enumerate(TRANSCRIPT)]
    lines = spark.createDataFrame(data, "session string, id bigint, line string")
    direct = hierarchy.replay_transcripts(lines, "session", "id", "line")
    totals = hierarchy.directory_totals(direct, ["session"])
    sizes = {(r["session"], "/".join(r["dir"])): r["size"] for r in totals.collect()}
    assert sizes["s1", "//a"] == 94853 and sizes["s1", "//a/e"] == 584 and sizes["s2", "/"] == 48381165
    small = totals.where("size < 100000").groupBy("session").agg(F.sum("size").alias("freed"))
    assert {r["session"]: r["freed"] for r in small.collect()} == {"s1": 95437, "s2": 95437}


def replay_by_force(lines):
    """Direct and total bytes per path, one line after the other."""
    path, totals = [], {}
    for line in lines:
        if line.startswith("$ cd "):
            path = path[:-1] if line == "$ cd .." else path + [line[5:]]
            for i in range(1, len(path) + 1):
                totals.setdefault(tuple(path[:i]), 0)
        elif line[0].isdigit() and path:
            for i in range(1, len(path) + 1):
                totals[tuple(path[:i])] += int(line.split()[0])
    return totals


def test_random_transcripts_equal_brute_force(spark):
    pick, data, want = random.Random(3), [], {}
    for session in range(4):
        lines, depth = ["$ cd /"], 1
        for _ in range(120):
            move = pick.random()
            if move < 0.3 and depth > 0:
                lines.append("$ cd ..")
                depth -= 1
            elif move < 0.6:
                lines.append(f"$ cd d{pick.randint(1, 3)}")
                depth += 1
            else:
                lines.append(f"{pick.randint(1, 999)} f")
        want.update({(session, p): v for p, v in replay_by_force(lines).items()})
        data += [(session, i, line) for i, line in enumerate(lines)]
    df = spark.createDataFrame(data, "session int, id bigint, line string")
    totals = hierarchy.directory_totals(hierarchy.replay_transcripts(df, "session", "id", "line"), ["session"])
    got = {(r["session"], tuple(r["dir"])): r["size"] or 0 for r in totals.collect()}
    assert got == want


@pytest.mark.parametrize("parts", [1, 5, 40])
def test_transcripts_cut_into_parts_equal_brute_force(spark, monkeypatch, parts):
    """Sessions that go on over many parts, one of them ever deeper and back; files before the first directory count nowhere."""
    monkeypatch.setattr(hierarchy, "parts_of", lambda df: parts)
    pick, sessions = random.Random(4), {7: [f"$ cd n{i}" for i in range(40)] + ["$ cd ..", "5 f"] * 39}
    for session in (None, 1, 2, 8, 9):
        lines, depth = ["12 f"], 0
        for _ in range(150 if session != 2 else 2):
            move = pick.random()
            if move < 0.35 and depth > 0:
                lines.append("$ cd ..")
                depth -= 1
            elif move < 0.7:
                lines.append(f"$ cd d{pick.randint(1, 3)}")
                depth += 1
            else:
                lines.append(f"{pick.randint(1, 999)} f")
        sessions[session] = lines
    data = [(session, i, line) for session, lines in sessions.items() for i, line in enumerate(lines)]
    pick.shuffle(data)
    direct = hierarchy.replay_transcripts(spark.createDataFrame(data, "session int, id bigint, line string"), "session", "id", "line")
    assert direct.count() == sum(line.startswith("$ cd ") and line != "$ cd .." for _, _, line in data)
    got = {(r["session"], tuple(r["dir"])): r["size"] or 0 for r in hierarchy.directory_totals(direct, ["session"]).collect()}
    assert got == {(session, path): size for session, lines in sessions.items() for path, size in replay_by_force(lines).items()}


@pytest.mark.parametrize("parts", [1, 4])
def test_leaving_an_empty_path_in_a_later_part_is_an_error(spark, monkeypatch, parts):
    monkeypatch.setattr(hierarchy, "parts_of", lambda df: parts)
    lines = ["$ cd a", "$ cd b", "$ cd .."] * 10 + ["$ cd .."] * 11 + ["$ cd c"] * 9
    data = [(s, i, line) for s in ("a", "b") for i, line in enumerate(lines if s == "b" else lines[:40])]
    df = spark.createDataFrame(data, "session string, id bigint, line string")
    with pytest.raises(PySparkException, match="cannot leave an empty path"):
        hierarchy.replay_transcripts(df, "session", "id", "line")


def test_transcripts_are_written_and_sorted_once(spark, monkeypatch):
    """The moves, and a row for each entered directory; the old replay wrote and sorted copies of all of them several times."""
    lines = ["$ cd /"] + [line for i in range(200) for line in (f"$ cd t{i % 5}", f"{i} f", f"$ cd d{i % 9}", "7 g", "$ cd ..", "$ cd ..")]
    data = [(s, i, line) for s in range(4) for i, line in enumerate(lines)]
    written = []
    for module in (hierarchy, ordered):
        plain = module.pin
        monkeypatch.setattr(module, "pin", lambda df, *name, plain=plain: (out := plain(df, *name), written.append(out.count()))[0])
    df = spark.createDataFrame(data, "session int, id bigint, line string")
    assert hierarchy.replay_transcripts(df, "session", "id", "line").count() == 4 * 401
    assert sum(written) < 2 * len(data)


def test_leaving_an_empty_path_is_an_error(spark):
    df = spark.createDataFrame([("s", 1, "$ cd a"), ("s", 2, "$ cd .."), ("s", 3, "$ cd ..")], "session string, id bigint, line string")
    with pytest.raises(PySparkException):
        hierarchy.replay_transcripts(df, "session", "id", "line")


def test_insert_ignore_and_merge(spark, as_rows):
    old = spark.createDataFrame([(1, "a", "old")], "id int, db string, query string")
    new = spark.createDataFrame([(1, "a", "new"), (2, "a", "z"), (2, "a", "y")], "id int, db string, query string")
    assert as_rows(merge.insert_ignore(old, new, ["id", "db"], ["query"])) == [(2, "a", "y")]
    target = spark.createDataFrame([(1, 10), (2, 5)], "k int, q int")
    delta = spark.createDataFrame([(2, 7), (3, 1)], "k int, q int")
    assert as_rows(merge.merge_additive(target, delta, ["k"], ["q"])) == [(1, 10), (2, 12), (3, 1)]
    changed = merge.changed_rows(delta, target.unionByName(delta.limit(0)), ["k", "q"])
    assert as_rows(changed) == [(2, 7), (3, 1)]


def search_by_force(term, names):
    def grams(s):
        s2 = s.rstrip()
        return {s[i:i + 3] for i in range(len(s2) - 2)}

    frequency = {}
    for n in names:
        for g in grams(n):
            frequency[g] = frequency.get(g, 0) + 1
    best = sorted((frequency[g], g) for g in grams(term) if g in frequency)[:3]
    return {n for n in names if best and all(g in grams(n) for _, g in best)}


def test_name_search_equals_brute_force(spark, as_rows):
    pick = random.Random(1)
    names = sorted({"".join(pick.choice("abc") for _ in range(pick.randint(1, 7))) for _ in range(80)})
    terms = names[::5] + ["zzz", "ab", "abcz"]
    people = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "id int, name string")
    wanted = spark.createDataFrame([(i, t) for i, t in enumerate(terms)], "q int, term string")
    got = as_rows(search.name_search(wanted, people, "q", "term", "id", "name"), "q", "name")
    assert got == sorted(((i, n) for i, t in enumerate(terms) for n in search_by_force(t, names)), key=repr)


def test_above_group_average_forms_agree(spark, as_rows):
    pick = random.Random(8)
    facts = spark.createDataFrame([(pick.randint(1, 40),) for _ in range(400)], "member int")
    members = spark.createDataFrame([(m, m % 4) for m in range(1, 46)], "member int, grp int")
    fast = reports.above_group_average(facts, members, "member", "grp", [])
    assert as_rows(fast, "member", "grp", "cnt") == as_rows(reports.above_group_average_correlated(facts, members))


def test_report_bounds_fall_back_to_the_snapshot_before(spark):
    moments = [dt.datetime(2024, 1, 1, h) for h in (1, 2, 3)]
    snaps = spark.createDataFrame([(m, dt.datetime(2024, 1, 1)) for m in moments], "created timestamp_ntz, stats_reset timestamp_ntz")
    as_of = dt.datetime(2024, 1, 1, 3, 10)
    assert monitoring.report_bounds(snaps, as_of, dt.timedelta(minutes=30)) == (moments[1], moments[2])
    assert monitoring.report_bounds(snaps, as_of, dt.timedelta(hours=3)) == (moments[0], moments[2])
    assert monitoring.report_bounds(snaps, as_of, dt.timedelta(minutes=1)) is None


def test_restart_gives_no_negative_rates(spark):
    t = dt.datetime(2024, 1, 1)
    data = [(t + dt.timedelta(minutes=i), c, r) for i, (c, r) in enumerate([(10, 1), (30, 1), (5, 2), (9, 2)])]
    snaps = spark.createDataFrame(data, "created timestamp_ntz, calls bigint, stats_reset int")
    for c in ("rows", "total_plan_time", "total_exec_time", "wal_bytes"):
        snaps = snaps.withColumn(c, F.col("calls"))
    out = [r["delta_rows"] for r in monitoring.cluster_trend(snaps, t, dt.timedelta(hours=1)).orderBy("time").collect()]
    assert out == [None, 20, None, 4]


def test_alert_states(spark, as_rows):
    now = dt.datetime(2024, 1, 1, 12)
    schema = "session_id int, login_name string, database_name string, program_name string, start_time timestamp_ntz"
    data = [(1, "u", "app", "p", now - dt.timedelta(minutes=40)), (2, "u", "app", "p", now - dt.timedelta(minutes=10)),
            (3, "u", "app", "p", now - dt.timedelta(minutes=1)), (4, "u", "msdb", "p", now - dt.timedelta(hours=2)),
            (5, "u", "app", "My Service Broker", now - dt.timedelta(hours=2))]
    active, as_of = spark.createDataFrame(data, schema), F.lit(now).cast("timestamp_ntz")
    none = active.limit(0)
    fresh = alerts.new_long_running(active, none, as_of)
    assert as_rows(fresh, "session_id", "email_sent") == [(1, False), (2, False)]
    told = alerts.mark_low(fresh, as_of)
    late = alerts.escalations(told, active, as_of)
    assert as_rows(late, "session_id") == [(1,)]
    done = alerts.mark_high(told, late, as_of)
    assert as_rows(done, "session_id", "email_sent", "email2_sent") == [(1, True, True), (2, True, False)]
    assert alerts.escalations(done, active, as_of).isEmpty()


def test_text_jobs_on_the_literal_fixtures(spark, as_rows):
    hands = spark.createDataFrame([(1, "32T3K 765")], "hand int, lines string")
    cards = texts.hand_cards(hands)
    assert as_rows(cards, "position", "card", "bid") == [(i + 1, c, "765") for i, c in enumerate("32T3K")]
    post = "Not as easy as you think\n#Wordle 511 3/6*\n🟨⬜🟨⬜⬜\n⬜🟨🟨🟨🟨\n🟩🟩🟩🟩🟩\n"
    scores = texts.guess_scores(spark.createDataFrame([(post,)], "body string"), "body")
    assert as_rows(scores) == [(1, 0, 2, 3), (2, 0, 4, 1), (3, 5, 0, 0)]
    sacks = spark.createDataFrame([(1, "vJrwpWtwJgWrhcsFMMfFFhFp"), (2, "abcdef")], "id int, contents string")
    assert as_rows(texts.shared_item_priority(sacks, "contents"), "id", "priority") == [(1, 16), (2, 0)]
    tasks = spark.createDataFrame([("2-8,3-7",), ("2-4,6-8",), ("6-6,4-6",)], "tasks string")
    assert [r["overlap"] for r in texts.nested_tasks(tasks, "tasks").collect()] == [1, 0, 1]


@FEW
@given(st.lists(st.tuples(*[st.integers(0, 12)] * 4), min_size=1, max_size=30))
def test_range_and_array_containment_agree(spark, items):
    pairs = [(f"{min(a, b)}-{max(a, b)},{min(c, d)}-{max(c, d)}",) for a, b, c, d in items]
    df = spark.createDataFrame(pairs, "tasks string")
    by_range = [r["overlap"] for r in texts.nested_tasks(df, "tasks").collect()]
    assert by_range == [r["overlap"] for r in texts.nested_tasks_by_values(df, "tasks").collect()]


def test_stored_index_takes_new_names_once(spark, as_rows):
    root = fresh_path(spark, "index")
    first = spark.createDataFrame([(1, "alpha"), (2, "beta")], "id int, name string")
    both = spark.createDataFrame([(2, "beta"), (3, "alphabet")], "id int, name string")
    search.add_names(first, "id", "name", root, 0)
    for _ in range(2):  # a load that runs again replaces itself
        search.add_names(both, "id", "name", root, 1)
    index, frequency = search.stored_index(spark, root)
    everything = search.trigram_index(first.union(both).distinct(), "id", "name")
    assert as_rows(index, "trigram", "id") == as_rows(everything, "trigram", "id")
    assert as_rows(frequency, "trigram", "cnt") == as_rows(search.trigram_frequency(everything), "trigram", "cnt")


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_windows_do_not_depend_on_the_number_of_parts(spark, monkeypatch, keys):
    rows = spark.range(3000).select("id", F.when(F.col("id") < 2500, 0).otherwise(F.col("id") % 7).alias("k"), (F.col("id") * 37 % 101).alias("v"))
    found = []
    for parts, shuffles in ((2, 2), (7, 7), (40, 200)):
        with monkeypatch.context() as m:
            m.setattr(ordered, "parts_of", lambda df: parts)
            m.setattr(ordered, "_FAN", 8)
            before = spark.conf.get("spark.sql.shuffle.partitions")
            spark.conf.set("spark.sql.shuffle.partitions", shuffles)
            try:
                sums = ordered.running_sum(rows, keys, ["id"], F.col("v"), "s")
                both = ordered.running_max(ordered.with_previous(sums, keys, "id", ["v"]), keys, ["id"], "v", "m")
                found.append(sorted(map(tuple, both.collect())))
            finally:
                spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] == found[2] and len(found[0]) == 3000


def test_parts_follow_the_bytes(spark, monkeypatch):
    rows = pin(spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("h")))
    few = ordered.parts_of(rows)
    monkeypatch.setattr(ordered, "PART_BYTES", 1 << 18)
    assert few == max(2, spark.sparkContext.defaultParallelism) and 30 <= ordered.parts_of(rows) <= 200
