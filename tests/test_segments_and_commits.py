import json

import pytest
from pyspark.sql import functions as F

from brontide.operators import contracts, depth, more
from brontide.sources import blocks, commits, segments


def envelope(ts, seq=1, market="m"):
    return json.dumps({"market": market, "kind": "trades", "event_ts": ts, "seq": seq, "payload": f"p{ts}"})


def test_segments_are_read_on_from_a_cursor(spark, tmp_path):
    d = tmp_path / "m/trades/2024-07-30"
    d.mkdir(parents=True)
    (d / "09.jsonl.active").write_text(envelope(1_000) + "\nbroken\n" + envelope(31_000) + "\n" + envelope(61_000)[:20])
    records, invalid, cursor = segments.read_segments(spark, str(tmp_path), "trades")
    assert [r.event_ts for r in records.orderBy("offset").collect()] == [1_000, 31_000] and [r.line for r in invalid.collect()] == ["broken"]
    seen = spark.createDataFrame(cursor.collect(), cursor.schema)
    text = (d / "09.jsonl.active").read_text()
    (d / "09.jsonl.active").unlink()
    (d / "09.jsonl").write_text(text + envelope(61_000)[20:] + "\n")  # renamed and grown
    records, _, cursor = segments.read_segments(spark, str(tmp_path), "trades", seen)
    assert [r.event_ts for r in records.collect()] == [61_000]
    out = {r.block_ms: (r.lines, r.sha256 is None) for r in segments.envelope_blocks(segments.read_segments(spark, str(tmp_path), "trades")[0], 0, 120_000).collect()}
    assert out == {0: (1, False), 30_000: (1, False), 60_000: (1, False), 90_000: (0, True)}
    (d / "09.jsonl").write_text("x\n")
    with pytest.raises(Exception, match="shorter than its cursor"):
        segments.read_segments(spark, str(tmp_path), "trades", seen)[2].collect()


def test_files_books_logs_and_seeds(spark, tmp_path):
    d = tmp_path / "book/m/1970-01-01"
    d.mkdir(parents=True)
    (d / "00-00-00.jsonl").write_text('{"ts":5,"type":"update","seq":3,"bids":[["1","2"]],"asks":[]}\n{"ts":6}\n')
    assert segments.discovered(spark, str(tmp_path), "book").first().market == "m" and segments.discovered(spark, str(tmp_path), "book", 10**9).isEmpty()
    (row,) = segments.book_updates(blocks.scan_blocks(spark, str(tmp_path), "book", 0, 30_000)).collect()
    assert (row.ts, row.seq, row.bids) == (5, 3, [["1", "2"]])
    log = tmp_path / "health.log"
    log.write_text('{"ts":1,"markets":{"a":{"state":"running","rate":2.5}}}\nnot json\n')
    assert [tuple(r) for r in segments.health_log(spark, str(log)).collect()] == [(1, "a", "running", 2.5)]
    seeds = tmp_path / "seeds.jsonl"
    seeds.write_text("\n".join(json.dumps({"market": "m", "ts": t, "bids": [[str(t), "1"]], "asks": []}) for t in (5, 9, 30)))
    assert segments.seeds_at(spark, str(seeds), 10).first().ts == 9 and segments.read_lines(spark, str(seeds)).count() == 3 and segments.read_json(spark, str(seeds)).count() == 3


def test_windows_are_committed_once(spark, tmp_path):
    root = str(tmp_path / "out")
    rows = spark.createDataFrame([(i, i * 2.0) for i in range(30)], "ts long, x double")
    assert [commits.commit(r, root, 0, n) for r, n in ((rows, 30), (rows.orderBy(F.desc("ts")), 30), (rows.limit(3), None))] == ["committed", "idempotent", "quarantined"]
    with pytest.raises(ValueError, match="E030"):
        commits.commit(rows.limit(3), root, 30, 30)
    rows.write.parquet(f"{root}/aside/window=60-1")
    rows.limit(2).write.parquet(f"{root}/aside/window=90-1")
    for w in (60, 90, 120):
        commits._fs(spark, root)[2].mkdirs(commits._fs(spark, f"{root}/intents")[1])
        commits._note(spark, f"{root}/intents/{w}.json", {"digest": commits.digest_of(rows), "aside": f"{root}/aside/window={w}-1", "generation": 1})
    assert commits.recover(spark, root) == {60: "committed", 90: "quarantined", 120: "quarantined"}
    assert {r.window for r in commits.manifest_of(spark, root).collect()} == {0, 60}
    assert sorted(r.window for r in commits.gap_records(commits.manifest_of(spark, root), 30, 0, 120).collect()) == [30, 90]


def test_rotation_and_status(spark, tmp_path):
    rows = spark.createDataFrame([("m", "trades", 3_600_000 * i, str(i)) for i in range(3)], "market string, kind string, event_ts long, payload string")
    commits.rotate(rows, str(tmp_path / "hot"))
    assert spark.read.json(str(tmp_path / "hot")).select("hour").distinct().count() == 3
    commits.status_file(spark.createDataFrame([("a", "running")], "market string, state string"), str(tmp_path / "status.json"))
    assert json.loads((tmp_path / "status.json").read_text()) == {"a": {"market": "a", "state": "running"}}


def test_update_flow_equals_a_plain_replay(spark):
    import random

    rnd, day, changes = random.Random(3), 86_400_000, []
    for k in range(400):
        changes.append(("m", rnd.choice(["bid", "ask"]), float(rnd.randrange(10)), float(rnd.choice([0, 0, 1, 2, 5])), rnd.randrange(4) * day + rnd.randrange(5), k))
    rows = spark.createDataFrame(changes, "market string, side string, price double, qty double, ts long, k long").withColumn("ord", F.struct("ts", "k"))
    got = {r.window: tuple(r)[2:] for r in depth.update_flow(rows, day // 2).collect()}
    books, want = {"bid": {}, "ask": {}}, {}
    best = lambda s: (max(books[s]) if s == "bid" else min(books[s])) if books[s] else None
    for _, side, price, qty, ts, _ in sorted(changes, key=lambda c: (c[4], c[5])):
        s = want.setdefault(ts - ts % (day // 2), [0.0] * 5)
        old = {x: (best(x), books[x].get(best(x), 0.0)) for x in books}
        change = qty - books[side].get(price, 0.0)
        books[side][price] = qty
        books[side] = {p: q for p, q in books[side].items() if q > 0}
        new = {x: (best(x), books[x].get(best(x), 0.0)) for x in books}
        for x, sign in (("bid", 1), ("ask", -1)):
            if None not in (old[x][0], new[x][0]) and sign * new[x][0] >= sign * old[x][0]:
                s[0] += sign * (new[x][1] - old[x][1])
            s[1] += max(0.0, new[x][1] - old[x][1])
            s[2] += max(0.0, old[x][1] - new[x][1])
        s[3] += max(0.0, change)
        s[4] += max(0.0, -change)
    assert got == {w: tuple(s) for w, s in want.items()}


def test_inventory_consumer_and_digests(spark):
    files = spark.createDataFrame([("m", "trades", 0, "a"), ("m", "trades", 0, "b"), ("m", "book", 0, "c"), (None, "book", 0, "d"), ("m", "x", 0, "e")], "market string, kind string, block_ms long, path string")
    inventory = contracts.frozen_inventory(files)
    assert {r.path: r.error for r in inventory.collect()} == {"a": "duplicate", "b": "duplicate", "c": None, "d": "field", "e": "kind"}
    wanted = spark.createDataFrame([("m", "book", 0), ("m", "book", 30)], "market string, kind string, block_ms long")
    assert {r.block_ms: r.absent for r in segments.inventory_lookup(wanted, inventory).collect()} == {0: False, 30: True}
    r = more.digests(spark.createDataFrame([("abc",)], "s string"), "s").first()
    assert (r.md5, r.crc32) == ("900150983cd24fb0d6963f7d28e17f72", 0x352441C2)
    rows = spark.createDataFrame([("m", 0), ("m", 300_000)], "market string, ts long")
    manifest = spark.createDataFrame([("m", 0, "x", "x"), ("m", 300_000, "x", "y")], "market string, ts long, sha256 string, found string")
    assert [segments.committed(rows, manifest, 0, 600_000, ok).count() for ok in (True, False)] == [1, 2]
    order = spark.createDataFrame([(None, 1, 0), (5, 2, 0), (5, 1, 1)], "event_ts long, ingest_seq long, position long").orderBy(*more.batch_order())
    assert [tuple(r) for r in order.collect()] == [(5, 1, 1), (5, 2, 0), (None, 1, 0)]
