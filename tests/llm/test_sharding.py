import zlib
from collections import Counter

import pytest

from reachmart.llm import sharding
from reachmart.llm.queries import shard_digest


def check(rows, shards):
    counts = Counter(r.shard for r in rows)
    sizes = [counts[s] for s in range(shards)]
    assert sum(sizes) == len(rows) and max(sizes) - min(sizes) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))


@pytest.mark.parametrize("bucket", [3, 2000])
def test_proportions(make_docs, bucket):
    rows = [(i, f"text {i}", "en", "big" if i % 3 else f"s{i % 7}") for i in range(500)] + [(None, "x", "en", None)] * 5
    docs = make_docs(rows, clashing=True)
    placed = sharding.interleave(docs, 4, bucket_rows=bucket)
    assert placed.columns == [c for c in docs.columns if c not in ("shard", "slot")] + ["shard", "slot"]
    got = placed.collect()
    check(got, 4)
    for source, n in Counter(r.source for r in got).items():
        each = Counter(r.shard for r in got if r.source == source)
        assert all(abs(each[s] - n / 4) < 2 for s in range(4))
    again = sharding.interleave(docs.orderBy("text"), 4, bucket_rows=bucket + 1).collect()
    assert {(r.doc_id, r.text): (r.shard, r.slot) for r in got if r.doc_id} == {(r.doc_id, r.text): (r.shard, r.slot) for r in again if r.doc_id}
    other = sharding.interleave(docs, 4, seed="1", bucket_rows=bucket).collect()
    assert {(r.doc_id, r.slot) for r in got} != {(r.doc_id, r.slot) for r in other}


def test_digest(make_docs, odd_rows):
    got = shard_digest(make_docs(odd_rows)).collect()
    check(got, 8)
    wanted = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in odd_rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == wanted
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}


@pytest.mark.parametrize("n", [0, 1, 5])
def test_few_rows(make_docs, n):
    check(sharding.interleave(make_docs([(i, "a") for i in range(n)]), 8).collect(), 8)
