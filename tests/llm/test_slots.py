from __future__ import annotations

import zlib

from pyspark.sql import functions as F

from millrace.llm import slots


def test_whole_rows(odd_rows, odd_docs, no_docs):
    result, stored = slots.shard_documents(odd_docs)
    got = result.collect()
    assert len(got) == len(odd_rows) and {r.law for r in got} == {"key"}
    want = sorted((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in odd_rows if i is not None)
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got if r.doc_id is not None) == want
    for s in {r.shard for r in got}:
        places = sorted(r.slot for r in got if r.shard == s)
        assert 0 <= s < 16 and places == list(range(len(places)))
    assert all(r.grown_shard in (r.shard, 16) for r in got)
    assert len({(r.doc_id, r.shard, r.grown_shard) for r in got}) == len({r.doc_id for r in got})
    sums = stored.filter("version = 1").agg(F.sum("slot_rows"), F.sum("slot_bytes"), F.count("*")).first()
    assert tuple(sums) == (len(odd_rows), sum(r.size for r in got), slots.SLOTS)
    assert slots.shard_documents(no_docs)[0].count() == 0


def test_the_key_alone_decides(odd_docs):
    all_rows = {r.doc_id: (r.shard, r.grown_shard) for r in slots.shard_documents(odd_docs)[0].collect()}
    some = slots.shard_documents(odd_docs.filter("doc_id % 3 = 1").repartition(3))[0].collect()
    assert some and all(all_rows[r.doc_id] == (r.shard, r.grown_shard) for r in some)


def test_growing_fills_only_the_new_shard(spark):
    old = slots.first_map(spark, 16)
    new = {r.virtual_slot: (r.version, r.shard) for r in slots.grow(old, 16).collect()}
    held = [0] * 17
    for r in old.collect():
        version, shard = new[r.virtual_slot]
        assert version == 2 and shard in (r.shard, 16)
        held[shard] += 1
    assert max(held) - min(held) <= 1


def test_rebalancing_moves_whole_slots_until_bytes_are_even(spark):
    old = slots.first_map(spark, 4, 64)
    load = spark.range(64).select(
        F.col("id").cast("int").alias("virtual_slot"), F.when(F.col("id") % 4 == 0, 100).otherwise(10).cast("long").alias("slot_bytes")
    )
    new = slots.rebalance(old, load)

    def bytes_of(m):
        return [r[1] for r in m.join(load, "virtual_slot").groupBy("shard").agg(F.sum("slot_bytes")).orderBy("shard").collect()]

    assert bytes_of(old) == [1600, 160, 160, 160]
    after = bytes_of(new)
    assert sum(after) == 2080 and max(after) - min(after) <= 200
    assert new.filter("version = 2").count() == 64
    moved = old.join(new.withColumnRenamed("shard", "to"), "virtual_slot").filter("shard <> to").select("shard").distinct()
    assert [r.shard for r in moved.collect()] == [0]


def test_the_map_is_stored_where_it_is_asked_for(spark, odd_docs, tmp_path):
    rows, stored = slots.shard_documents(odd_docs, map_path=f"{tmp_path}/map")
    later = spark.read.parquet(f"{tmp_path}/map")  # by another run
    assert sorted(map(tuple, later.collect())) == sorted(map(tuple, stored.collect()))
    assert rows.count() == odd_docs.count() and later.filter("version = 2").count() == slots.SLOTS
    plain = slots.shard_documents(odd_docs)[0]
    assert sorted(map(tuple, plain.collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)
