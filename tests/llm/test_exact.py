"""Operators with exact results, against brute-force versions."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.llm import debruijn, decontaminate, exact_dedup, minhash, ordering, packing, suffixarray, suffixsort, tokens

from .fixtures import SCHEMA, docs, pairs, rows, same

LOW = {i: i + 32 for i in range(65, 91)}
SPACE_WORDS = r"[^\x20\x09-\x0D]+"


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents")
    docs(spark).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_exact_dedup(table, empty):
    groups = defaultdict(list)
    for i, t in pairs(table):
        groups[t or ""].append(i)
    want = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        want += [(i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    same(rows(exact_dedup.exact_dedup(table), "doc_id", "keep_id", "group_size", "kept", "text_sha256"), want)
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_exact_dedup_parts_texts_of_one_digest(spark, table, monkeypatch):
    monkeypatch.setattr(exact_dedup, "digest_of", lambda text: F.substring(F.sha2(text, 256), 1, 1))
    groups = defaultdict(list)
    for i, t in pairs(table):
        groups[t or ""].append(i)
    want = [(i, keep, len(ids), i == keep) for ids in groups.values() for keep in [max((i for i in ids if i is not None), default=None)] for i in ids]
    same(rows(exact_dedup.exact_dedup(table), "doc_id", "keep_id", "group_size", "kept"), want)


@pytest.mark.parametrize("hot", [1, 10**9])
def test_exact_dedup_with_and_without_hot_digests(spark, table, monkeypatch, hot):
    monkeypatch.setattr(exact_dedup, "HOT_SHARE", hot)
    groups = Counter(t or "" for _, t in pairs(table))
    same(rows(exact_dedup.exact_dedup(table), "doc_id", "group_size"), [(i, groups[t or ""]) for i, t in pairs(table)])


def test_dedup_state_goes_on(spark, tmp_path):
    landing, state = str(tmp_path / "landing"), str(tmp_path / "state")
    for lot in ([(1, "a"), (2, "b")], [(3, "a"), (0, "c")]):
        exact_dedup.land(spark.createDataFrame(lot, "doc_id long, text string"), landing)
        exact_dedup.advance(spark, landing, state)
    got = {r["digest"]: (r["keep_id"], r["copies"]) for r in exact_dedup.state(spark, state).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == {sha("a"): (3, 2), sha("b"): (2, 1), sha("c"): (0, 1)}


def shingles(t):
    w = re.findall(SPACE_WORDS, (t or "").translate(LOW))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def near(found):
    """Component of each row number, linked by the contract's rule; rows without an id stay alone."""
    part = list(range(len(found)))

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    sets = [shingles(t) for _, t in found]
    for i in range(len(found)):
        for j in range(i):
            x, y = sets[i], sets[j]
            if x and y and found[i][0] is not None and found[j][0] is not None and 100 * len(x & y) >= 75 * len(x | y):
                part[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(found):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return [(d, len(sets[i]), least.get(root(i)) if d is not None else None, d is None or least[root(i)] == d) for i, (d, _) in enumerate(found)]


def test_near_duplicates(table, empty):
    same(rows(minhash.near_duplicates(table), "doc_id", "n_shingles", "component_id", "kept"), near(pairs(table)))
    assert minhash.near_duplicates(empty).count() == 0


def test_near_duplicates_of_a_large_edited_group(spark):
    import random

    rng = random.Random(4)
    base = [f"w{i}" for i in range(60)]
    lot = []
    for i in range(220):
        w = list(base)
        for _ in range(rng.randrange(0, 5)):
            at = rng.randrange(len(w))
            w[at : at + 1] = rng.choice([[], [f"e{rng.randrange(40)}"], [f"u{i}", "v"]])
        lot.append((i, " ".join(w)))
    df = spark.createDataFrame(lot, "doc_id long, text string")
    same(rows(minhash.near_duplicates(df), "doc_id", "n_shingles", "component_id", "kept"), near(lot))


@pytest.mark.parametrize("share,short", [(1, 0), (10**9, 2)])
def test_near_duplicates_with_and_without_hot_keys(table, monkeypatch, share, short):
    """Every key hot, or none; and lists refined as far as they can be."""
    monkeypatch.setattr(minhash, "SHORT", short)
    monkeypatch.setattr(minhash, "HOT_SHARE", share)
    same(rows(minhash.near_duplicates(table), "doc_id", "n_shingles", "component_id", "kept"), near(pairs(table)))


def family(n, seed=0):
    """Documents of one shared header and three of forty common blocks, some of them a few words apart."""
    rng = np.random.default_rng(seed)
    blocks = [" ".join(f"b{i}x{j}" for j in range(40)) for i in range(40)]
    header = " ".join(f"h{j}" for j in range(40))
    lot = []
    for i in range(n):
        text = " ".join([header, *(blocks[b] for b in rng.choice(40, 3, replace=False))])
        lot.append((i, text if i % 10 else lot[-1][1] + f" x{i}" if lot else text))
    return lot


def test_near_duplicates_of_shared_blocks(spark, monkeypatch):
    """A family of boilerplate: links are found, and compared pairs grow about as the documents do, not as their pairs."""
    compared = []
    agreeing = minhash._agreeing
    monkeypatch.setattr(minhash, "_agreeing", lambda pairs, reps: compared.append(pairs.count()) or agreeing(pairs, reps))
    seen = []
    monkeypatch.setattr(minhash, "SHORT", 16)
    for n in (400, 1600):
        lot = family(n)
        got = rows(minhash.near_duplicates(spark.createDataFrame(lot, "doc_id long, text string")), "doc_id", "n_shingles", "component_id", "kept")
        if n == 400:
            same(got, near(lot))
        assert any(not r[3] for r in got)
        seen.append(sum(compared))
        compared.clear()
    print("compared", seen)
    assert seen[1] < 8 * seen[0]


def alnum(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))


def contaminated(found, items):
    wins = defaultdict(set)
    for name, t in items:
        w = alnum(t)
        for i in range(max(1, len(w) - 12) if w else 0):
            wins[tuple(w[i : i + 13])].add(name if name is not None else "null")
    out = []
    for d, t in found:
        w, hit, its = alnum(t), set(), set()
        for n in {len(x) for x in wins}:
            for i in range(len(w) - n + 1):
                if (own := wins.get(tuple(w[i : i + n]))) and len(w[i : i + n]) == n:
                    hit |= set(range(i, i + n))
                    its |= own
        out.append((d, len(w), len(hit), sorted(its), bool(hit) and 20 * len(hit) >= len(w)))
    return out


@pytest.mark.parametrize("block", [1_000_000, 20])
def test_decontamination(spark, table, empty, block):
    words = pairs(table)
    long = next(t for i, t in words if i == 121)
    items = [("1", long[20:200]), ("2", "Word"), ("3", "d, e!"), ("4", None), ("5", ""), (None, "e D c B a e d c b a e d c b"), ("1", "one two three"), ("7", long[30:160])]
    bench = spark.createDataFrame(items, "item_id string, text string")
    got = decontaminate.contamination(table, bench, block_words=block)
    want = [(d, n, h, ",".join(its), c) for d, n, h, its, c in contaminated(words, items)]
    assert any(w[4] for w in want)
    same(rows(got.withColumn("its", F.array_join("items", ",")), "doc_id", "n_words", "n_hit", "its", "contaminated"), want)
    assert decontaminate.contamination(empty, bench).count() == 0
    assert decontaminate.contamination(table, spark.createDataFrame([], "item_id string, text string")).filter("n_hit > 0").count() == 0
    cut = {r["doc_id"]: r["clean_text"] for r in decontaminate.cut_spans(got, 3).filter("doc_id IN (134, 141)").collect()}
    assert cut == {134: "Word", 141: " four five six"}


def removed(starts, n, width):
    gone = np.zeros(n, dtype=bool)
    for s in starts:
        gone[s : s + width] = True
    return gone


def test_repeated_words(table, empty):
    found = [(d, re.findall(SPACE_WORDS, t or "")) for d, t in pairs(table)]
    seen = Counter(tuple(w[i : i + 35]) for _, w in found for i in range(len(w) - 34))
    want = []
    for d, w in found:
        gone = removed([i for i in range(len(w) - 34) if seen[tuple(w[i : i + 35])] > 1], len(w), 35)
        want.append((d, len(w), int(gone.sum()), hashlib.sha256(" ".join(x for x, g in zip(w, gone) if not g).encode()).hexdigest()))
    assert sum(w[2] > 0 for w in want) > 5
    same(rows(debruijn.repeated_spans(table), "doc_id", "n_words", "n_removed", "kept_sha256"), want)
    assert debruijn.repeated_spans(empty).count() == 0


@pytest.mark.parametrize("hot", [1000, 2])
def test_repeated_bytes(table, empty, hot, monkeypatch):
    monkeypatch.setattr(suffixarray, "HOT_SHARE", hot if hot == 1000 else 10**9)
    found = [(d, (t or "").encode()) for d, t in pairs(table)]
    seen = Counter(b[i : i + 200] for _, b in found for i in range(len(b) - 199))
    want = []
    for d, b in found:
        gone = removed([i for i in range(len(b) - 199) if seen[b[i : i + 200]] > 1], len(b), 200)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        want.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, dtype=np.uint8)[~gone].tobytes()).hexdigest()))
    same(rows(suffixarray.repeated_bytes(table), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"), want)
    assert suffixarray.repeated_bytes(empty).count() == 0


def test_suffix_sorting(tmp_path, monkeypatch):
    monkeypatch.setattr(suffixsort, "RANGE", 8)
    rng = np.random.default_rng(2)
    for t in range(150):
        a = rng.integers(1, rng.integers(2, 8), rng.integers(1, 60))
        x = np.append(np.tile(a[:9], 6) if t % 3 == 0 else a, 0).astype(np.int32)
        folder = tmp_path / str(t)
        folder.mkdir()
        got = np.array(suffixsort.sort_suffixes(x, suffixsort.Store(str(folder), [1 << 20, 5][t % 2]))).tolist()
        assert got == sorted(range(len(x)), key=lambda i: x[i:].tolist())


def test_packing(table, empty):
    got = packing.pack(table, capacity=64).collect()
    encoder = tokens.Encoder.of(tokens.default_path())
    want = []
    for d, t in pairs(table):
        ids = np.array([*encoder.tokenizer.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        want += [(d, i, a, len(ids[a : a + 64]), zlib.crc32(ids[a : a + 64].tobytes())) for i, a in enumerate(range(0, len(ids), 64))]
    same([tuple(r)[:5] for r in got], want)
    ends = defaultdict(int)
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends[r["sequence_id"]]
        ends[r["sequence_id"]] += r["length"]
    assert max(ends.values()) <= 64 and len(ends) <= -(-sum(ends.values()) // 64) + 1
    assert packing.pack(empty).count() == 0


def test_plans_use_every_piece():
    rng = np.random.default_rng(0)
    for _ in range(30):
        counts = np.zeros(33, dtype=np.int64)
        np.add.at(counts, rng.integers(1, 33, 200), rng.integers(0, 4, 200))
        used = np.zeros_like(counts)
        for times, content in packing.plan(counts, 32):
            assert sum(content) <= 32
            np.add.at(used, list(content), times)
        assert (used == counts).all()


def test_chunk_encoding_equals_the_tokenizer():
    encoder = tokens.Encoder(tokens.default_path())
    odd = ["a<|endoftext|>b <|startoftext|>c", "don't I'll  x y ́z é İSTANBUL ΣΑΣ", "", "1234 a1b2 \x1c x\x1dy \x85 　 z", "end. stop!? \x01 a\x01b ﬁ Å"]
    for _ in range(2):
        assert [np.frombuffer(x, dtype="<u4").tolist() for x in encoder.ids([t.encode() for t in odd])] == [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in odd]


@pytest.mark.parametrize("lot,most", [(8 << 20, 100_000), (2000, 3)])
def test_training_order(spark, table, empty, tmp_path, monkeypatch, lot, most):
    monkeypatch.setattr(ordering, "LOT_BYTES", lot)
    monkeypatch.setattr(ordering, "MOST_SHARDS", most)
    path = f"file://{tmp_path}/shards"
    got = ordering.materialise(table, path, length=16, block=40).collect()
    assert sorted(r["slot"] for r in got) == list(range(len(got)))
    reader = ordering.Reader(path, 16)
    assert len(reader.names) <= most
    encoder = tokens.Encoder.of(tokens.default_path())
    found = sorted(((d, spark_hash, t) for d, t, spark_hash in ((r["doc_id"], r["text"] or "", r["h"]) for r in table.selectExpr("doc_id", "text", "xxhash64(coalesce(text, '')) h").collect())), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    want = []
    for d, _, t in found:
        ids = [*encoder.tokenizer.encode(t, add_special_tokens=False).ids, 0]
        want += [(d, i // 16, ids[i : i + 16]) for i in range(0, len(ids), 16)]
    slots = ordering.Feistel(len(want), 20)(np.arange(len(want)))
    assert len(reader) == len(got) == len(want) and reader.read(len(got), 5).shape == (0, 16)
    every = reader.read(0, len(got))
    assert (np.concatenate([reader.read(0, 33), reader.read(33, len(got))]) == every).all()
    for slot, (_, _, ids) in zip(slots.tolist(), want):
        assert every[slot].tolist() == ids + [0] * (16 - len(ids))
    same([(r["doc_id"], r["piece"], r["n_tokens"], r["ids_crc32"], r["slot"]) for r in got], [(d, p, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()), s) for (d, p, ids), s in zip(want, slots.tolist())])
    for r in got[::7]:
        with open(f"{tmp_path}/shards/shard-{r['shard']:08d}.bin", "rb") as f:
            f.seek(32 * r["position"])
            assert np.frombuffer(f.read(32), dtype="<u2").tolist() == every[r["slot"]].tolist()
    assert ordering.materialise(empty, f"file://{tmp_path}/none").count() == 0


def test_a_cache_that_is_too_small(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE", 50)
    encoder = tokens.Encoder(tokens.default_path())
    rng = np.random.default_rng(1)
    for _ in range(20):
        lot = [" ".join(f"w{x}y" for x in rng.integers(0, 60, 30)) for _ in range(rng.integers(0, 4))]
        assert [np.frombuffer(x, dtype="<u4").tolist() for x in encoder.ids([t.encode() for t in lot])] == [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in lot]


def test_training_order_is_that_of_the_rows_alone(spark, table, tmp_path):
    place = lambda df, name: sorted((r["slot"], str(r["doc_id"]), r["piece"], r["ids_crc32"]) for r in ordering.materialise(df, f"file://{tmp_path}/{name}", length=16, block=40).collect())
    assert place(table, "a") == place(table.repartition(7), "b")


def test_wide_ids_fail():
    with pytest.raises(ValueError):
        ordering._small(np.array([65536], dtype="<u4").tobytes())


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000])
def test_feistel_is_a_bijection(n):
    assert sorted(ordering.Feistel(n, 5)(np.arange(n)).tolist()) == list(range(n))
