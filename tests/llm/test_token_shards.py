import numpy as np
import pytest

pytest.importorskip("public_tokenizers")
from sendero.llm import bpe, token_shards  # noqa: E402


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 17, 1000, 4097])
def test_permutation(n):
    p = token_shards.Feistel(n, 99)
    slots = p.slot(np.arange(n))
    assert sorted(slots.tolist()) == list(range(n))
    assert (p.number(slots) == np.arange(n)).all()
    if n > 100:
        assert (slots != token_shards.Feistel(n, 98).slot(np.arange(n))).mean() > 0.9


def test_shards_hold_every_token_once(spark, tmp_path):
    rows = [(i, f"text {i} " * (i % 40), "x") for i in range(300)] + [(None, None, "y"), (7, "", "z"), (7, "", "z"), (1000, "long " * 20000, "w")]
    spark.createDataFrame(rows, "doc_id bigint, text string, ids string").repartition(3).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    shards, n = token_shards.write_shards(docs, length=32, per_shard=50)
    back = sorted(token_shards.read_slots(shards).collect())
    assert [r.slot for r in back] == list(range(n))
    assert all(len(r.ids) == 64 and r.shard == r.slot // 50 and r.offset == r.slot % 50 * 64 for r in back)
    ids = {r.id: r.ids for r in bpe.encode(docs).collect() if r.id != 7}
    number = token_shards.Feistel(n, 20240101).number(np.arange(n))
    stream = np.concatenate([np.frombuffer(bytes(back[s].ids), "<u2") for s in np.argsort(number)])
    end = 50256
    assert (stream == end).sum() >= len(rows)
    got = []
    for part in np.split(stream, np.flatnonzero(stream == end)):
        part = part[part != end]
        if len(part):
            got.append(tuple(part.tolist()))
    assert sorted(got) == sorted(tuple(r.ids) for r in bpe.encode(docs).collect() if r.ids)
    for r in back:
        for d in r.docs:
            assert d is None or d == 7 or set(ids[d]) & set(np.frombuffer(bytes(r.ids), "<u2").tolist()) or end in np.frombuffer(bytes(r.ids), "<u2")
    some = sorted(token_shards.read_slots(shards, 60, 117).collect())
    assert some == back[60:117]
    assert sorted(token_shards.read_slots(token_shards.write_shards(docs, length=32, per_shard=50)[0]).collect()) == back
    assert token_shards.write_shards(docs.limit(0))[1] == 0


def test_docs_are_the_owners_of_the_tokens(spark, tmp_path):
    rows = [(i, None if i % 7 == 0 else "" if i % 3 else "some words " * (i % 11)) for i in range(400)]
    spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    assert docs.rdd.getNumPartitions() == 1
    owner = [r.id for r in bpe.encode(docs).collect() for _ in range(len(r.ids or []) + 1)]
    for length in (1, 4, 7):
        shards, n = token_shards.write_shards(docs, length=length, per_shard=50)
        got = {r.slot: r.docs for r in token_shards.read_slots(shards).collect()}
        slot = token_shards.Feistel(n, 20240101).slot(np.arange(n))
        want = [list(dict.fromkeys(owner[k : k + length])) for k in range(0, len(owner), length)]
        assert [got[s] for s in slot.tolist()] == want


def test_files_of_a_fixed_stride_and_resumed_writes(spark, tmp_path):
    rows = [(i, f"word {i} and more " * (i % 30), 1) for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, slot int").repartition(4)
    place = f"file://{tmp_path}/out"
    shards, n = token_shards.write_shards(docs, length=16, per_shard=20, place=place)
    files = sorted((tmp_path / "out").glob("shard-*.bin"))
    assert len(files) == -(-n // 20) > token_shards.IN_RANGE and not (tmp_path / "out/sequences").exists()
    assert all(f.stat().st_size == 20 * 32 for f in files[:-1])
    back = {r.slot: bytes(r.ids) for r in token_shards.read_slots(shards).collect()}
    assert b"".join(back[s] for s in range(n)) == b"".join(f.read_bytes() for f in files)
    whole = [f.read_bytes() for f in files]
    index = sorted(shards.collect())
    files[3].unlink()
    files[9].unlink()
    made = {f: f.stat().st_mtime_ns for f in files if f.exists()}
    again, m = token_shards.write_shards(docs, length=16, per_shard=20, place=place)
    assert m == n and [f.read_bytes() for f in files] == whole
    assert all(f.stat().st_mtime_ns == t for f, t in made.items())
    assert sorted(again.collect()) == index


def test_a_place_that_was_used_before_gives_the_result_of_an_empty_one(spark, tmp_path, monkeypatch):
    """Other docs, another key, another length, other partitions after a whole run; an encoded table left by other docs."""
    rows = [(i, f"word {i} and more " * (i % 30)) for i in range(400)]
    schema = "doc_id bigint, text string"
    first, other = spark.createDataFrame(rows, schema).repartition(3), spark.createDataFrame([(i + 1000, f"other {i} " * (i % 20)) for i in range(300)], schema).repartition(2)
    dealt = spark.createDataFrame(rows[::-1], schema).repartition(5)
    place, fresh = f"file://{tmp_path}/used", iter(range(100))

    def state(docs, where, **more):
        shards, n = token_shards.write_shards(docs, per_shard=8, place=where, **more)
        return n, [(r.slot, bytes(r.ids), r.docs) for r in sorted(token_shards.read_slots(shards).collect())], sorted(p.name for p in (tmp_path / where.rsplit("/", 1)[1]).glob("*.bin"))

    for docs, more in ((first, {"length": 64}), (other, {"length": 64}), (first, {"length": 64, "key": 5}), (dealt, {"length": 64, "key": 5}), (dealt, {"length": 32}), (first.limit(0), {"length": 32}), (first, {"length": 64})):
        assert state(docs, place, **more) == state(docs, f"file://{tmp_path}/fresh{next(fresh)}", **more)
        assert not (tmp_path / "used/sequences").exists() and not (tmp_path / "used/sequences.json").exists()

    # A run that breaks off while it writes leaves its encoded table.
    class Broken(Exception):
        pass

    def fails(*_):
        raise Broken

    for docs, same in ((first, True), (other, False)):
        where = f"file://{tmp_path}/broken{same}"
        with monkeypatch.context() as m:
            m.setattr(token_shards, "Feistel", fails)
            with pytest.raises(Broken):
                token_shards.write_shards(first, length=64, per_shard=8, place=where)
        assert (tmp_path / f"broken{same}/sequences.json").exists()
        with monkeypatch.context() as m:
            if same:
                m.setattr(token_shards, "sequences", fails)  # they are not made again
            made = state(docs, where, length=64)
        assert made == state(docs, f"file://{tmp_path}/fresh{next(fresh)}", length=64)
