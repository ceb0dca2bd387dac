"""SimHash groups, sharding, packing, and the pipeline."""

import bisect
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

import corpus_pipeline
from millrace.llm import components, decontaminate, packing, pii, sharding, simhash, toxicity
from millrace.llm.common import ChunkEncoder, with_place
from millrace.session import setting
from tests.llm.helpers import documents, odd, scanned
from tests.llm.test_measures import labels, prose
from tests.llm.test_near_copies import edited, groups


def fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(marks, distance=4):
    root = list(range(len(marks)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(marks)):
        for j in range(i):
            if bin(marks[i] ^ marks[j]).count("1") <= distance:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(marks))]


def variants(n=60):
    r, out = random.Random(3), []
    for i in range(n):
        words = prose(i, r.randrange(1, 90)).split()
        out.append(" ".join(words))
        for _ in range(r.randrange(3)):
            copy = list(words)
            copy[r.randrange(len(copy))] = "changed"
            out.append(" ".join(copy))
    return out + ["", None, " ", out[0], out[0].upper()]


def test_simhash_against_brute_force(spark):
    texts = variants()
    rows = {r["doc_id"]: r for r in simhash.query(spark, documents(spark, *texts)).collect()}
    marks = [fingerprint(t) for t in texts]
    assert [rows[i]["fingerprint"] for i in range(len(texts))] == [f"{m:016x}" for m in marks]
    assert [rows[i]["component_id"] for i in range(len(texts))] == brute_groups(marks)


@pytest.mark.parametrize("segments, block", [(2, 1 << 16), (3, 1 << 16), (4, 1 << 16), (3, 7), (2, 40)])
def test_links_connect_what_all_pairs_connect(spark, segments, block):
    r = random.Random(segments)
    centres = [r.getrandbits(64) for _ in range(12)]
    marks = sorted({c ^ sum(1 << b for b in r.sample(range(64), r.randrange(9))) for c in centres for _ in range(40)})
    signed = [m - (1 << 64) if m >> 63 else m for m in marks]
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    found = simhash.linked(df, 4, segments, block).collect()
    assert all(bin((a ^ b) & (2**64 - 1)).count("1") <= 4 for a, b in found)
    roots = {x["node"]: x["root"] for x in components.components(simhash.linked(df, 4, segments, block)).collect()}
    want = brute_groups(marks)
    for i in range(len(marks)):
        for j in range(i):
            assert (roots.get(signed[i], signed[i]) == roots.get(signed[j], signed[j])) == (want[i] == want[j])


def test_no_cell_of_a_crowded_entry_holds_more_than_two_blocks(spark):
    """Fingerprints of one crowded segment value: its own entry and its neighbours' look-ups are cut."""
    r = random.Random(8)
    marks = sorted({r.getrandbits(40) for _ in range(4000)})
    hot = spark.createDataFrame([(0, 5, m, p, 8, 6) for p in (False, True) for m in marks], "seg int, val long, fp long, probe boolean, _kt long, _kp long")
    cells = simhash._cells(hot).groupBy("_cell").agg(F.count("*").alias("n")).collect()
    assert len(cells) == 8 * 9 // 2 + 8 * 6 and max(c["n"] for c in cells) < 1.4 * 4000 * (1 / 8 + 1 / 6)
    links = simhash.linked(spark.createDataFrame([(m,) for m in marks[:600]], "fp long"), 4, 3, 50)
    assert links.count() == 0 or all(bin(a ^ b).count("1") <= 4 for a, b in links.collect())


def test_places_are_of_the_files_and_not_of_the_partitions(spark, tmp_path):
    docs = scanned(spark, documents(spark, *[prose(i, 300) for i in range(400)]).withColumn("_PLACE", F.lit(7)).repartition(3), tmp_path / "d")

    def places():
        placed, name = with_place(docs)
        assert name == "_place_"
        return placed.rdd.getNumPartitions(), {(r["doc_id"], r[name]) for r in placed.select("doc_id", name).collect()}

    few, before = places()
    with setting(spark, "spark.sql.files.maxPartitionBytes", "20000"):
        many, after = places()
    assert few < many and before == after and len({p for _, p in before}) == 400
    # A frame that is no scan is stored first; its own columns stay as they are.
    made = documents(spark, "a b c", "a b c", ids=[1, 1]).withColumn("_place", F.lit(7))
    kept = simhash.keep_one(spark, made, "").collect()
    assert len(kept) == 1 and kept[0]["_place"] == 7


def test_components_of_long_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 160)]
    df = spark.createDataFrame(chain + star + [(7, 7), (41, 40)], "u long, v long")
    got = {r["node"]: r["root"] for r in components.components(df).collect()}
    assert got == {**{i: 0 for i in range(42)}, **{i: 100 for i in range(100, 160)}}


def test_keep_one_of_each_group(spark, tmp_path):
    texts = [prose(1, 80), prose(2, 80), prose(1, 80), "", None, prose(2, 80), prose(3, 80), prose(3, 80)]
    docs = scanned(spark, documents(spark, *texts, ids=[9, 4, 3, 8, 7, 4, None, None]).repartition(3), tmp_path / "d")
    kept = simhash.keep_one(spark, docs, "")
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert len(rows) == 4 and {r["doc_id"] for r in rows} == {3, 4, 7, None}


def test_simhash_on_odd_and_empty_tables(spark):
    rows = simhash.query(spark, odd(spark)).collect()
    assert len(rows) == 9 and [r["component_id"] for r in rows if r["fingerprint"] == "0" * 16] == [0] * 4
    assert simhash.query(spark, odd(spark).limit(0)).collect() == []


@pytest.mark.parametrize("n", [0, 5, 100])
def test_shards_are_even_and_whole(spark, n):
    texts = [prose(i, i % 30) for i in range(n)]
    rows = sharding.query(spark, documents(spark, *texts).repartition(4)).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(n))
    slots = [sorted(r["slot"] for r in rows if r["shard"] == s) for s in range(24)]
    assert all(s == list(range(len(s))) for s in slots)
    assert max(map(len, slots)) - min(map(len, slots)) <= 1
    for r in rows:
        text = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(text) + 8, zlib.crc32(text))


def test_written_shards_hold_whole_records(spark, tmp_path):
    docs = scanned(spark, odd(spark), tmp_path / "in")
    written = sharding.write_shards(docs, str(tmp_path / "out"), shards=2, bucket_bytes=1000)
    back = written.select("record.*").collect()
    assert sorted(map(str, back)) == sorted(map(str, docs.collect()))
    again = sharding.shard(docs, 2, bucket_bytes=1000).select("record.doc_id", "shard", "slot").collect()
    assert sorted(map(str, again)) == sorted(map(str, written.select("record.doc_id", "shard", "slot").collect()))


def best_fit_decreasing(lengths, capacity):
    gaps, n = [], 0
    for length in sorted(lengths, reverse=True):
        at = bisect.bisect_left(gaps, length)
        gap = gaps.pop(at) if at < len(gaps) else capacity
        n += gap == capacity
        if gap > length:
            bisect.insort(gaps, gap - length)
    return n


@pytest.mark.parametrize("seed", range(6))
def test_sweep_equals_best_fit_decreasing(seed):
    r = random.Random(seed)
    capacity = r.choice([10, 64, 4096])
    lengths = [min(capacity - 1, max(1, int(r.expovariate(4 / capacity)))) for _ in range(3000)] + [capacity // 3] * 1000
    counts = {n: lengths.count(n) for n in set(lengths)}
    fill, ranks = {}, {n: [] for n in counts}
    runs = packing.sweep(counts, capacity)
    by_length = {n: sorted(x for x in runs if x[0] == n) for n in counts}
    for n, own in by_length.items():
        for i, (_, rank, first, each, offset) in enumerate(own):
            end = own[i + 1][1] if i + 1 < len(own) else counts[n]
            for k in range(end - rank):
                fill.setdefault(first + k // each, []).append((offset + k % each * n, n))
                ranks[n].append(rank + k)
    assert all(sorted(x) == list(range(counts[n])) for n, x in ranks.items())
    for places in fill.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= capacity
    assert len(fill) == best_fit_decreasing(lengths, capacity)


def check_packing(texts, rows, capacity=4096):
    encoder, by_doc, by_sequence = ChunkEncoder(), {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for i, ids in texts.items():
        ids = next(encoder.encode([(ids or "").encode()])) + np.array([1], "<u4").tobytes()
        own = sorted(by_doc[i], key=lambda r: r["piece"])
        parts = [ids[a : a + 4 * capacity] for a in range(0, len(ids), 4 * capacity)]
        assert [(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in own] == [
            (n, n * capacity, len(p) // 4, zlib.crc32(p)) for n, p in enumerate(parts)]
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    short = [r["length"] for r in rows if r["length"] < capacity]
    assert len(by_sequence) == len(rows) - len(short) + best_fit_decreasing(short, capacity)


def test_packing(spark):
    texts = {i: prose(i, n) for i, n in enumerate([0, 1, 3, 3, 3, 50, 900, 1500, 1600, 9000])}
    check_packing(texts, packing.query(spark, documents(spark, *texts.values())).collect())
    kept = packing.pack(documents(spark, *texts.values()), keep_ids=True).collect()
    assert all(len(r["ids"]) == r["length"] and zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in kept)


def test_packing_on_odd_and_empty_tables(spark):
    rows = packing.query(spark, odd(spark)).collect()
    assert sum(r["start"] == 0 for r in rows) == 9
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == len(rows)
    assert packing.query(spark, odd(spark).limit(0)).collect() == []


def test_pipeline_stage_by_stage(spark, tmp_path):
    """run() equals the stages' brute-force versions, each on what its predecessor kept."""
    r = random.Random(6)
    texts = [prose(i, 70) + (" " + " ".join(r.choice(["scumbag", "vermin"]) for _ in range(4)) if i % 5 == 0 else "") for i in range(120)]
    texts += [texts[1], " ".join(edited(r, texts[2].split(), 1)), None, ""]
    leaked = "a leaked item of the benchmark with quite a few words that nobody else has ever said"
    texts += [prose(500, 40) + " " + leaked + " " + prose(501, 40), "mail me at bob.7@example.com or on +1 (017) 555-7713 " + prose(502, 40)]
    docs = documents(spark, *texts)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels(spark, [(i, 1, int(i % 5 == 0)) for i in range(120)]).write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, leaked), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()

    scores = toxicity.query(spark, docs, spark.read.parquet(str(tmp_path / "labels.parquet"))).collect()
    stay = {r["doc_id"] for r in scores if not r["predicted"]}
    left = [i for i in range(len(texts)) if i in stay]
    first = groups([texts[i] for i in left])
    left = [i for n, i in enumerate(left) if n in first]
    left = [i for i in left if leaked not in (texts[i] or "")]
    final = {i: texts[i] for i in left}
    last = len(texts) - 1
    assert last in final and last - 1 not in final and 120 not in final and 121 not in final
    final[last] = texts[last].replace("bob.7@example.com", "[EMAIL]").replace("+1 (017) 555-7713", "[PHONE]")
    assert {r["doc_id"] for r in rows} == set(final)
    check_packing(final, rows)


def test_stages_on_odd_and_empty_tables(spark, tmp_path):
    odd(spark).write.parquet(str(tmp_path / "documents.parquet"))
    labels(spark, []).write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for stage in (toxicity.stage, simhash.keep_one, decontaminate.stage, pii.stage):
        kept = stage(spark, docs, str(tmp_path))
        assert kept.columns == docs.columns and kept.count() == (9 if stage is not simhash.keep_one else 5)
        assert stage(spark, docs.limit(0), str(tmp_path)).collect() == []
