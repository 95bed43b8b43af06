import hashlib
import zlib
from unittest import mock

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mercato.llm import prefix_trie as t
from mercato.llm.queries import ORACLES, op11_prefix_trie, rebuilt

COLUMNS = "conv_id long, turn long, role string, text string"


def plain(convs):
    """Nodes of {conv_id: [(key, bytes), ...]} by dictionaries."""
    nodes = {}
    for conv, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(k for k, _ in turns[:d]), []).append(conv)
    size = {tuple(k for k, _ in turns[:d]): (turns[d - 1][1] if d else 0) for turns in convs.values() for d in range(len(turns) + 1)}
    children = {}
    for path in nodes:
        if path:
            children.setdefault(path[:-1], []).append(path)
    leaves, saved = {}, {}
    for path in sorted(nodes, key=len, reverse=True):
        own = children.get(path, [])
        leaves[path] = sum(leaves[c] for c in own) if own else 1
        saved[path] = (len(nodes[path]) - 1) * size[path] + sum(saved[c] for c in own)
    out = []
    for path, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(convs[c]) == len(path))
        out.append((min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members), len(children.get(path, [])), leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def turns_of(rows):
    """Turns by conversation, as (role and text, bytes)."""
    convs = {}
    for conv, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        convs.setdefault(conv, []).append(((role or "", text or ""), len((text or "").encode())))
    return convs


def rebuild(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + own[h:]
    return out


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


def by_shards(convs, cuts):
    """The same from shards cut at the given places, without Spark: shard_nodes, then recombine."""
    import pyarrow as pa

    distinct = {}
    for c, turns in sorted(convs.items()):
        distinct.setdefault(tuple(turns), []).append(c)
    rows = sorted(distinct, key=lambda turns: [x for (hi, lo), _ in turns for x in (hi, lo)])
    edges = [0, *sorted(cut % (len(rows) + 1) for cut in cuts), len(rows)]
    kind = pa.list_(pa.struct([("hi", pa.int64()), ("lo", pa.int64()), ("size", pa.int64())]))
    nodes = []
    for number, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        part = rows[a:b][::-1]
        batch = pa.RecordBatch.from_arrays([
            pa.array([distinct[r][0] for r in part], pa.int64()), pa.array([[{"hi": hi, "lo": lo, "size": size} for (hi, lo), size in r] for r in part], kind),
            pa.array([len(distinct[r]) for r in part], pa.int64()), pa.array([hashlib.sha256(",".join(map(str, distinct[r])).encode()).hexdigest() for r in part], pa.string())],
            ["conv_id", "turns", "n", "ends"])
        with mock.patch("pyspark.TaskContext.get", return_value=mock.Mock(partitionId=lambda n=number: n)):
            nodes += [x for out in t.shard_nodes(iter([batch])) for x in out.to_pylist()]
    spine = sorted((n for n in nodes if n["slot"] is not None), key=lambda n: (n["shard"], n["slot"]))
    joined = [x for out in t.recombine(iter([pa.RecordBatch.from_pylist(spine, schema=t.NODE)])) for x in out.to_pylist()] if spine else []
    name = {x["id"]: x["conv_id"] for x in joined if x["shard"] is None}
    link = {(x["shard"], x["slot"]): name[x["id"]] for x in joined if x["shard"] is not None}
    rest = [x | {"parent_conv_id": link[x["shard"], x["parent_slot"]] if x["parent_slot"] is not None else x["parent_conv_id"]} for x in nodes if x["slot"] is None]
    whole = [x | {"parent_conv_id": name.get(x["parent"])} for x in joined if x["shard"] is None]
    return sorted((tuple(x[n] for n in ("conv_id", "depth", "parent_conv_id", *t.COUNTS[1:], "ends_sha256")) for x in rest + whole), key=repr)


turn = st.tuples(st.tuples(st.integers(-1, 1), st.sampled_from([0, np.iinfo(np.int64).min])), st.just(7))
conversation = st.lists(turn, max_size=5) | st.integers(10, 40).flatmap(lambda n: st.just([((0, 0), 7)] * n))


@settings(max_examples=400, deadline=None)
@given(st.lists(conversation, max_size=14), st.lists(st.integers(0, 14), max_size=5))
def test_any_cut_into_shards_gives_the_same_nodes(convs, cuts):
    convs = {i * 3: turns for i, turns in enumerate(convs)}
    assert by_shards(convs, cuts) == plain(convs)


@pytest.mark.parametrize("shard_turns", [3, t.SHARD_TURNS])
def test_odd_rows(llm, shard_turns):
    hot = [(100 + c, n, "user" if n % 2 else None, f"turn {n}") for c in range(30) for n in range(3)]
    long = [(c, n, "user", f"long {n} é") for c in (1, 2) for n in range(70)] + [(3, n, "user", f"long {n} é") for n in range(48)]
    odd = [(None, 0, "user", "x"), (7, None, "user", "first"), (7, 5, None, None), (7, 2, "", ""), (8, 1, "user", ""), (8, 1, "user", ""), (9, 0, "a", "b" * 200_000), (-4, 0, "user", "long 0 é"), (11, None, None, None)]
    rows = hot + long + odd
    df = llm.createDataFrame(rows, COLUMNS).withColumns({"Turns": F.lit(1), "hi": F.lit(2), "depth": F.lit(3)})
    seqs = t.sequences(df.repartition(5))
    assert found(t.prefix_trie(seqs, shard_turns)) == plain(turns_of(rows))
    assert found(t.prefix_trie(rebuilt(t.sequences(df)), shard_turns)) == plain(rebuild(turns_of([r for r in rows if r[0] != -4])) | rebuild_negative(rows))


def rebuild_negative(rows):
    """-4 - (-4 % 5) is 0 where the remainder has the dividend's sign: no such conversation."""
    own = turns_of(rows)[-4]
    return {-4: own[zlib.crc32(b"-4") % 9:]}


def test_ties_and_empty_table(llm):
    rows = [(c, 1, "user", x) for c, texts in ((1, "ab"), (2, "ba")) for x in texts]
    nodes = found(t.prefix_trie(t.sequences(llm.createDataFrame(rows, COLUMNS))))
    assert [n[3] for n in nodes] == [2, 2, 2]  # turns of one number are put in one order
    assert t.prefix_trie(t.sequences(llm.createDataFrame([], COLUMNS))).count() == 0


def test_query_equals_plain_trie_and_sql(llm):
    folder = "/root/testdata/sf0.001"
    rows = found(op11_prefix_trie(llm, folder))
    table = [tuple(r) for r in llm.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows == plain(rebuild(turns_of(table)))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet'")
    assert sorted(con.execute(ORACLES["op11_prefix_trie"]).fetchall(), key=repr) == rows
