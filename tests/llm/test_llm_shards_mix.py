"""Sharding by best-fit decreasing and mixing by weighted fair queueing."""

import random
import zlib

from shoplens.llm import mixing, sharding

DDL = "doc_id long, text string, source string, size string, shard int, row int, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1, 2, 3) for r in rows], DDL)


def docs(n, seed=1):
    rng = random.Random(seed)
    rows = [(i, "w" * rng.randint(0, 400) + " x" * rng.randint(0, 60), rng.choice(["a", "b", "é", "B", None])) for i in range(n)]
    rows += [(n + i, "same text here", "a") for i in range(n // 3)]  # a third of copies
    rows += [(None, None, None), (5, "", "a"), (7, "dup", "b"), (7, "dup", "b"), (9, "long " * 3000, "é")]
    return rows


def test_tree_matches_a_sorted_list():
    rng, tree, own = random.Random(2), sharding.RoomTree(), []
    for i in range(600):
        if own and rng.random() < 0.45:
            key = own.pop(rng.randrange(len(own)))
            tree.remove(key)
        else:
            own.append((rng.randint(0, 50), i))
            tree.add(own[-1])
        size = rng.randint(0, 55)
        assert tree.tightest(size) == min([k for k in own if k[0] >= size], default=None)


def test_best_fit_is_best_fit_decreasing():
    rng = random.Random(3)
    for _ in range(40):
        items = sorted(((rng.randint(1, 30), i) for i in range(25)), key=lambda x: (-x[0], x[1]))
        rooms, naive = [], {}
        for size, name in items:
            fit = [(r, k) for k, r in enumerate(rooms) if r >= size]
            k = min(fit)[1] if fit else len(rooms)
            if not fit:
                rooms.append(40)
            rooms[k] -= size
            naive[name] = k
        assert sharding.best_fit(items, 40) == naive
        place = sharding.pack_into(items, 5)
        load = [sum(s for s, n in items if place[n] == k) for k in range(5)]
        assert max(load) <= 1.15 * sum(load) / 5 + 1


def test_shards_hold_groups_whole_and_near_equal(spark):
    rows = docs(400)
    out = [r.asDict() for r in sharding.assign_shards(frame(spark, rows).repartition(4), shards=5).collect()]
    key = lambda d, t: (str(d), len((t or "").encode()) + 8, zlib.crc32((t or "").encode()))
    assert sorted(key(d, t) for d, t, _ in rows) == sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in out)
    group = {}
    for r in out:
        assert group.setdefault((r["size"], r["text_crc32"]), r["shard"]) == r["shard"]
    for k in range(5):
        own = [r for r in out if r["shard"] == k]
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    load = [sum(r["size"] for r in out if r["shard"] == k) for k in range(5)]
    assert max(load) - min(load) <= 0.02 * sum(load) / 5
    again = {(r["doc_id"], r["slot"], r["shard"]) for r in sharding.assign_shards(frame(spark, rows).repartition(7), shards=5).collect()}
    assert len(again ^ {(r["doc_id"], r["slot"], r["shard"]) for r in out}) == 0


def test_shards_empty_table_and_one_huge_group(spark):
    assert sharding.assign_shards(frame(spark, [])).count() == 0
    rows = [(i, "the same", "a") for i in range(50)] + [(99, "other", "a")]
    out = sharding.assign_shards(frame(spark, rows), shards=3).collect()
    assert len({r["shard"] for r in out if r["size"] == 16}) == 1 and len(out) == 51


def test_other_shards_stay_even_beside_giants():
    rng = random.Random(4)
    for giants in ([100_000], [60_000, 30_000], [15_000]):  # of 200,000 bytes and more of others
        items = [(s, f"giant{i}") for i, s in enumerate(giants)] + [(rng.randint(1, 40), f"x{i:05}") for i in range(10_000)]
        place = sharding.pack_into(items, 24)
        load = [sum(s for s, n in items if place[n] == k) for k in range(24)]
        assert set(place) == {n for _, n in items} and sorted(load)[-len(giants):] == sorted(giants)
        others = sorted(load)[:-len(giants)]
        assert others[-1] - others[0] <= 0.02 * others[-1]
    assert sorted(sharding.pack_into([(9, "a"), (0, "c"), (1, "b")], 5)) == ["a", "b", "c"]
    assert sharding.pack_into([], 5) == {}


def test_a_group_of_a_third_leaves_no_shard_empty(spark):
    rows = docs(400)
    n = sum(len((t or "").encode()) + 8 for _, t, _ in rows)
    rows += [(10_000 + i, "g" * 992, "a") for i in range(n // 2000)]  # a third of all bytes
    out = sharding.assign_shards(frame(spark, rows), shards=8).collect()
    load = [sum(r["size"] for r in out if r["shard"] == k) for k in range(8)]
    giant = sum(r["size"] for r in out if r["size"] == 1000)
    others = sorted(load)[:-1]
    assert len(out) == len(rows) and max(load) == giant and others[-1] - others[0] <= 0.1 * others[-1]


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: [3, 1, 2][i % 3] for i, s in enumerate(names)}
    budget, full = 1.5 * sum(sizes.values()), set()
    while True:
        rest = budget - sum(2 * sizes[s] for s in full)
        w = sum(weight[s] for s in names if s not in full)
        target = {s: 2 * sizes[s] if s in full else rest * weight[s] / w for s in names}
        over = {s for s in names if s not in full and target[s] > 2 * sizes[s]}
        if not over:
            return target
        full |= over


def test_mix_meets_targets(spark):
    rows = docs(500)
    words = lambda t: len((t or "").split())
    out = [r.asDict() for r in mixing.mix(frame(spark, rows).repartition(4)).collect()]
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + words(t)
    target = brute_targets(sizes)
    assert sorted((str(r["doc_id"]), r["size"]) for r in out) == sorted((str(d), words(t)) for d, t, _ in rows)
    got = {}
    for r in out:
        assert 0 <= r["times"] <= 2
        got.setdefault((r["source_size"], round(r["target"], 6)), []).append(r["times"] * r["size"])
    assert {k: None for k in got} == {(sizes[s], round(target[s], 6)): None for s in target}
    for (size, t), taken in got.items():
        assert abs(sum(taken) - t) <= max(words(x) for _, x, s in rows if sizes[s] == size) / 2
    key = lambda r: (str(r["doc_id"]), r["size"], r["times"])
    again = mixing.mix(frame(spark, rows).repartition(9)).collect()
    assert sorted(map(key, again)) == sorted(map(key, out))


def test_mix_follows_the_queues(spark):
    """Brute force: documents in shuffled order, twice over, until half a document is past the target."""
    from pyspark.sql import functions as F
    rows = [(i, "a " * (1 + i % 7), "s%d" % (i % 3)) for i in range(90)]
    df = frame(spark, rows)
    result = mixing.mix(df).collect()
    out = {r["doc_id"]: r for r in result}
    assert [r["finish"] for r in result] == sorted(r["finish"] for r in result)
    draw = {r["doc_id"]: r["d"] for r in df.select("doc_id", F.xxhash64(F.lit(8), "doc_id", "text").alias("d")).collect()}
    times = dict.fromkeys(out, 0)
    for k in range(3):
        own, served = sorted((r for r in rows if r[2] == f"s{k}"), key=lambda r: draw[r[0]]), 0
        for d, t, _ in own * 2:
            served += len(t.split())
            times[d] += served - len(t.split()) / 2 <= out[d]["target"] + 1e-9
    assert times == {d: r["times"] for d, r in out.items()}


def test_mix_empty_tables(spark):
    assert mixing.mix(frame(spark, [])).count() == 0
    assert [(r["size"], r["times"], r["target"], r["finish"]) for r in mixing.mix(frame(spark, [(1, None, None), (2, "", "a")])).collect()] == [(0, 0, 0.0, None)] * 2


def test_draw_mix_keeps_columns_of_any_name(spark):
    rows = [(i, "a b c", "s" if i % 2 else "t", i, "k") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _turn int, __Key string")
    got = mixing.draw_mix(docs)
    assert got.schema == docs.schema and {tuple(r) for r in got.collect()} <= set(rows) and got.count() >= 20


def test_mix_is_cut_once_on_the_global_order(spark):
    """Brute force: all turns of all sources in one list by words over weight, cut where the words due reach the budget."""
    from pyspark.sql import functions as F
    rows = [(i, "a " * (1 + i * i % 23), "s%d" % (i % 5 % 4)) for i in range(150)]
    df = frame(spark, rows)
    draw = {r["doc_id"]: r["d"] for r in df.select("doc_id", F.xxhash64(F.lit(8), "doc_id", "text").alias("d")).collect()}
    size = {s: sum(len(t.split()) for _, t, k in rows if k == s) for s in {r[2] for r in rows}}
    weight = {"s0": 3, "s1": 1, "s2": 2, "s3": 3}
    order = []
    for s in size:
        served = 0
        for turn in range(2):
            for d, t, _ in sorted((r for r in rows if r[2] == s), key=lambda r: draw[r[0]]):
                order.append(((served + len(t.split()) / 2) / weight[s], draw[d], d, turn))
                served += len(t.split())
    due = lambda v: sum(min(v * weight[s], 2 * size[s]) for s in size)
    taken = [(d, turn) for at, _, d, turn in sorted(order) if due(at) <= 1.5 * sum(size.values()) + 1e-9]  # a middle at the cut itself is taken
    assert 0 < len(taken) < len(order) and any(due(1e9) > due(at) for at, *_ in order)
    got = mixing.schedule(df.repartition(5))[1].collect()
    assert [(r["doc_id"], r["turn"]) for r in got] == taken
    assert sorted(r["doc_id"] for r in mixing.draw_mix(df).collect()) == sorted(d for d, _ in taken)


def test_draw_mix_of_repeated_rows(spark):
    rows = [(7, "a b c", "s")] * 6 + [(7, "a b c", None)] * 2 + [(None, None, "s"), (8, "", "s")]
    got = mixing.draw_mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    times = {r["doc_id"]: r["times"] for r in mixing.mix(frame(spark, [(i, "a b c", "s") for i in range(6)] + [(i, "a b c", None) for i in (6, 7)])).collect()}
    assert {r["doc_id"] for r in got} == {7} and len(got) == sum(times.values())
