"""MinHash near-duplicates by an inverted join over signature coordinates.

A document's set is its distinct five-word shingles (64-bit hashes). Documents of equal sets become one. A
signature has ``COORDINATES`` minima under independent hash functions; two sets of similarity s agree in each with
probability s. A link (s >= 3/4) agrees in fewer than ``MATCHES`` of 64 with probability below 1e-7, so only pairs
with that many are candidates. Such a pair must share one of the first ``COORDINATES - MATCHES + 1`` coordinate-value
pairs in any common order, so documents are posted under that prefix alone, frequent pairs last: a document is posted at all only if
it shares ``MATCHES`` coordinates with others, and a passage that many documents share is posted only by those that it
makes up for the most part.

Posting lists aren't expanded into all pairs. In a first round each list's members are compared with its most typical one (whose
pairs occur most: in a group of edited copies, the text that the others were made from), in a second with the smallest, and
members that are linked by then need no comparison. What is left
in different components of one list goes through prefix lists of the full sets, refined until they are short (``_across``). Every link is
confirmed on the full sets; components come from star joins.

Defined results: fewer than five words are one shingle; no words or null text: an empty set, linked with nothing; repeated rows are
linked (equal sets) and carry one component; texts of one id are documents of their own; rows with a null id keep a null component and aren't linked.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.bitmaps import bitmap, contains
from cadenza.llm.common import HOT_SHARE, Scratch, hashes_of, id_and_text, measured_joins, salted_join
from cadenza.llm.components import connected_components
from cadenza.llm.words import LOWER, NOT_SPACE, U64, Powers, mix, split, text_slices

SHINGLE = 5
COORDINATES, MATCHES = 64, 28
#: In a list, at most so many members outside the largest component are compared with all others; a list with more is refined, so many times at most.
SHORT, DEPTH = 128, 40
LOT_BYTES = 8 << 20
SET_NAME = ("set_a", "set_b", "n_shingles")
_POWERS = Powers(0x9E3779B97F4A7C15)
_FACTORS = mix(np.arange(1, COORDINATES + 1, dtype=U64) * U64(0xA0761D6478BD642F)) | U64(1)
_SHIFTS = mix(np.arange(1, COORDINATES + 1, dtype=U64) * U64(0xE7037ED1A0B428DB))


def shingle_sets(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each row."""
    for first, last, data, offsets in text_slices(batch):
        words = split(data, offsets, NOT_SPACE, LOWER)
        sums = _POWERS.sums(words.hashes())
        every = _POWERS.windows(sums, SHINGLE)
        for i in range(last - first):
            a, b = int(words.ptr[i]), int(words.ptr[i + 1])
            if b - a >= SHINGLE:
                yield first + i, np.unique(every[a : b - SHINGLE + 1])
            elif b > a:
                yield first + i, mix(_POWERS.spans(sums, np.array([a]), np.array([b])) + U64(b - a))
            else:
                yield first + i, every[:0]


def signature(found: np.ndarray) -> np.ndarray:
    """The minima of a set that isn't empty."""
    out = np.empty(COORDINATES, dtype="<u4")
    for at in range(0, COORDINATES, 16):
        part = np.full(16, np.iinfo(np.uint64).max, dtype=U64)
        for lot in range(0, len(found), 1 << 14):
            some = found[lot : lot + (1 << 14)]
            part = np.minimum(part, ((some[None, :] ^ _SHIFTS[at : at + 16, None]) * _FACTORS[at : at + 16, None]).min(axis=1))
        out[at : at + 16] = part >> U64(32)
    return out


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, row (a hash of id and text), text_sha256, n_shingles, set_a and set_b (a 128-bit cryptographic digest of the set), signature, uid (one a row)."""
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = np.zeros(batch.num_rows, dtype=np.int64)
            name = np.zeros((batch.num_rows, 2), dtype=np.int64)
            signed: list[bytes | None] = [None] * batch.num_rows
            for row, found in shingle_sets(batch):
                n[row] = len(found)
                if len(found):
                    name[row] = np.frombuffer(hashlib.blake2b(found.tobytes(), digest_size=16).digest(), dtype="<i8")
                    signed[row] = signature(found).tobytes()
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "row", "text_sha256")), pa.array(n), pa.array(name[:, 0]), pa.array(name[:, 1]), pa.array(signed, type=pa.binary())], names=["doc_id", "row", "text_sha256", "n_shingles", "set_a", "set_b", "signature"])

    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), F.sha2("text", 256).alias("text_sha256"), "text")
    return rows.mapInArrow(made, "doc_id long, row long, text_sha256 string, n_shingles long, set_a long, set_b long, signature binary").withColumn("uid", F.monotonically_increasing_id())


def _keys(batch: pa.RecordBatch) -> np.ndarray:
    values = np.frombuffer(b"".join(batch.column("signature").to_pylist()), dtype="<u4").reshape(-1, COORDINATES)
    return (np.arange(COORDINATES, dtype=np.int64) << 32) | values


def _exploded(reps: DataFrame) -> DataFrame:
    """(key, node, n_shingles): each document under all its coordinate-value pairs."""
    def posted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(_keys(batch).ravel()), *(pa.array(np.repeat(batch.column(c).to_numpy(), COORDINATES)) for c in ("node", "n_shingles"))], names=["key", "node", "n_shingles"])

    return reps.select("node", "n_shingles", "signature").mapInArrow(posted, "key long, node long, n_shingles long")


def postings(reps: DataFrame, scratch: Scratch) -> DataFrame:
    """(key, node, n_shingles, weight): each document under its prefix, the rarest of its pairs; ``weight`` is how often all its pairs occur.

    The pairs are counted exactly. Those of one document alone come first in the common order and lead nowhere, so a document
    is posted under as many of its shared pairs as it has beyond ``MATCHES - 1``.
    """
    every = _exploded(reps)
    shared = scratch.table(every.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "shared")
    hot = shared.filter(F.col("n") * HOT_SHARE >= COORDINATES * reps.count()).select("key")
    found = salted_join(every, shared, "key", hashes_of(hot, "key"), "inner", "node")
    lists = found.groupBy("node", "n_shingles").agg(F.sum("n").alias("weight"), F.array_sort(F.collect_list(F.struct("n", "key"))).alias("pairs")).filter(F.size("pairs") >= MATCHES)
    return lists.select(F.explode(F.slice("pairs", F.lit(1), F.size("pairs") - (MATCHES - 1))).alias("x"), "node", "n_shingles", "weight").select("x.key", "node", "n_shingles", "weight")


def _with_both(pairs: DataFrame, values: DataFrame, value: str) -> DataFrame:
    """(a, b, xa, xb): the pairs with both documents' values. A list's leader is in many pairs, so its side is joined last and, where it is hot, dealt over salts."""
    hot = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") * HOT_SHARE >= pairs.count()).select("a")
    one = pairs.join(values.select(F.col("node").alias("b"), F.col(value).alias("xb")), "b")
    return salted_join(one, values.select(F.col("node").alias("a"), F.col(value).alias("xa")), "a", hot, "inner", "b").select("a", "b", "xa", "xb")


def _agreeing(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs (a, b) whose signatures agree in at least MATCHES coordinates."""
    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype="<u4").reshape(-1, COORDINATES) for c in ("xa", "xb"))
                ok = pa.array((x == y).sum(axis=1) >= MATCHES)
                yield pa.RecordBatch.from_arrays([batch.column("a").filter(ok), batch.column("b").filter(ok)], names=["a", "b"])

    return _with_both(pairs, reps, "signature").mapInArrow(agree, "a long, b long")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets are linked: 4 * intersection >= 3 * union."""
    def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("xa"), batch.column("xb")):
                x, y = np.frombuffer(x.as_buffer(), dtype="<u8"), np.frombuffer(y.as_buffer(), dtype="<u8")
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                common = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                ok.append(4 * common >= 3 * (len(x) + len(y) - common))
            ok = pa.array(ok, type=pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(ok), batch.column("b").filter(ok)], names=["a", "b"])

    return _with_both(pairs, sets, "members").mapInArrow(sized, "a long, b long")


def _sets(docs: DataFrame, wanted: DataFrame, shared: Broadcast) -> DataFrame:
    """(node, members) of ``wanted`` (node, doc_id, row). The scan makes sets of the rows that a bitmap of the wanted ones knows; no text is shuffled."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(contains(shared.value, batch.column("row").to_numpy().view(U64))))
            members: list[bytes] = []
            first, size = 0, 0
            for row, found in shingle_sets(batch):
                members.append(found.tobytes())
                size += 8 * len(found)
                if size >= LOT_BYTES or row == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(first, len(members)) for c in ("doc_id", "row")), pa.array(members, type=pa.binary())], names=["doc_id", "row", "members"])
                    members, first, size = [], row + 1, 0

    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), "text").mapInArrow(made, "doc_id long, row long, members binary")
    return rows.join(wanted, ["doc_id", "row"]).groupBy("node").agg(F.first("members").alias("members"))


def _tokens(rows: DataFrame) -> DataFrame:
    """(group, node, token) of rows (group, node, members)."""
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [np.frombuffer(x.as_buffer(), dtype=np.int64) for x in batch.column("members")]
            if values:
                lens = [len(v) for v in values]
                yield pa.RecordBatch.from_arrays([*(pa.array(np.repeat(batch.column(c).to_numpy(), lens)) for c in ("group", "node")), pa.array(np.concatenate(values))], names=["group", "node", "token"])

    return rows.select("group", "node", "members").mapInArrow(spread, "group long, node long, token long")


def _posted(rows: DataFrame) -> DataFrame:
    """Members under their classes of tokens, as far as the tokens before leave a link possible.

    ``rows`` have group, node, n_shingles, component, skipped, matched, floor (no partner is smaller) and ``common``: the tokens that other members of the group have too, as (n, class) in order.
    Returned: the finer group, what it was made of (group, n, class), and skipped and matched as they are in it.
    """
    arrow = pa.schema([(c, pa.int64()) for c in ("finer", "group", "node", "n_shingles", "component", "skipped", "matched", "n", "class")])

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                common = part.column("common")
                lens = np.array([len(c) for c in common], dtype=np.int64)
                own = np.repeat(np.arange(len(lens)), lens)
                flat = common.flatten()
                n, kind = (flat.field(c).to_numpy() for c in ("n", "class"))
                head = np.ones(len(own), dtype=bool)
                head[1:] = (own[1:] != own[:-1]) | (n[1:] != n[:-1]) | (kind[1:] != kind[:-1])
                at = np.flatnonzero(head)
                weight = np.diff(np.append(at, len(own)))
                doc = own[at]
                size, skipped, matched, remaining, floor = (part.column(c).to_numpy() for c in ("n_shingles", "skipped", "matched", "remaining", "floor"))
                least = -(-3 * (size + np.maximum(-(-3 * size // 4), floor)) // 7)  # of the set in common with any partner
                # tokens that no other member has come first, then the classes before
                before = (skipped + remaining - lens)[doc] + at - (np.cumsum(lens) - lens)[doc]
                able = before <= (size - least)[doc]
                at, doc, weight, before = at[able], doc[able], weight[able], before[able]
                group = part.column("group").to_numpy()[doc]
                finer = mix(mix(group.view(U64) + U64(0x9E3779B97F4A7C15)) ^ kind[at].view(U64) + n[at].view(U64)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (finer, group, part.column("node").to_numpy()[doc], size[doc], part.column("component").to_numpy()[doc], before, matched[doc] + weight, n[at], kind[at])], schema=arrow)

    return rows.mapInArrow(post, ", ".join(f"`{f.name}` long" for f in arrow))


def _across(posted: DataFrame, found: DataFrame, sets: DataFrame, scratch: Scratch, settle: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """The components after all links between different ones of a list; ``settle`` takes candidate pairs and gives the components with their links.

    A document may miss a quarter of its set in a partner. Its tokens are put in the order of their frequency in its group, so the first
    that a partner shares has no more than that before it: the document is posted under the tokens up to there.
    Tokens that the same members have are one class and are posted once. Where no more than ``SHORT`` members of a list are outside its largest component,
    those are compared with all others. A list with more is a group again: its members share what they were posted under (``matched``) and don't share what
    came before (``skipped``), and the tokens after it are ordered by their frequency in it. Members that share nothing more are linked if
    3 * (n_a + n_b) <= 7 * matched, which holds for any two of them only if it holds for each and the smallest, so they are paired with that one alone.
    """
    live = scratch.table(_with_component(posted, found), "live")
    mixed = scratch.table(live.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("least"), F.max("component").alias("most"), F.min("n_shingles").alias("floor")).filter("least < most").select("key", "n", "floor"), "mixed")
    crowded = mixed.filter(F.col("n") * HOT_SHARE >= live.count()).select("key")
    members = salted_join(live, mixed.select("key", "floor"), "key", hashes_of(crowded, "key"), "inner", "node").groupBy("node", "n_shingles", "component").agg(F.min("floor").alias("floor"))
    zero = F.lit(0).cast("long")
    state = scratch.table(members.select(zero.alias("group"), "node", "n_shingles", "component", zero.alias("skipped"), zero.alias("matched"), "floor", F.col("n_shingles").alias("remaining")), "group-0")
    scratch.drop("live")
    tokens = _tokens(sets.join(state.select("group", "node"), "node"))
    for depth in range(DEPTH + 1):
        total = state.agg(F.coalesce(F.sum("remaining"), zero)).first()[0]
        often = scratch.table(tokens.groupBy("group", "token").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("node")).alias("class")).filter("n > 1").withColumn("key", F.struct("group", "token")), f"often-{depth}")
        hot = often.filter(F.col("n") * HOT_SHARE >= total).select("key")
        known = salted_join(tokens.select("node", F.struct("group", "token").alias("key")), often.select("key", "n", "class"), "key", hashes_of(hot, "key"), "inner", "node")
        known = known.groupBy(F.col("key.group").alias("group"), "node").agg(F.array_sort(F.collect_list(F.struct("n", "class", F.col("key.token").alias("token")))).alias("common"))
        known = scratch.table(state.join(known, ["group", "node"]), f"common-{depth}")
        lists_of = scratch.table(_posted(known), f"posted-{depth}")
        scratch.drop(f"often-{depth}")
        scratch.drop(f"finer-{depth - 1}")
        scratch.release()
        by_component = lists_of.groupBy("finer", "component").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("n_shingles", "node", "component")).alias("small"))
        lists = by_component.groupBy("finer").agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("size"), F.max(F.struct("n", F.col("component").alias("main"))).alias("most"), F.min("small").alias("small")).filter("kinds > 1")
        lists = scratch.table(lists.select("finer", "size", "most.main", (F.col("size") - F.col("most.n")).alias("outside"), "small"), f"lists-of-{depth}")
        crowded = lists.filter(F.col("size") * HOT_SHARE >= lists_of.count()).select("finer")
        # a partner has three quarters of the set at least, and no less than the smallest of the list
        able = 7 * (F.col("n_shingles") - F.col("skipped")) >= 3 * (F.col("n_shingles") + F.greatest(F.ceil(F.col("n_shingles") * 3 / 4), F.col("small.n_shingles")))
        mine = scratch.table(salted_join(lists_of, lists, "finer", crowded, "inner", "node").filter(able), f"mine-{depth}")
        scratch.drop(f"posted-{depth}")
        star = mine.filter("3 * (n_shingles + small.n_shingles) <= 7 * matched AND component <> small.component").select(F.least("node", "small.node").alias("a"), F.greatest("node", "small.node").alias("b"))
        last = depth == DEPTH
        short = mine if last else mine.filter(F.col("outside") <= SHORT)
        others = short.filter("component <> main").select("finer", F.col("node").alias("other"), F.col("n_shingles").alias("n_b"), F.col("component").alias("component_b"), F.col("skipped").alias("skipped_b"))
        # what either has left after the tokens before must be enough for a link
        enough = 7 * F.least(F.col("n_shingles") - F.col("skipped"), F.col("n_b") - F.col("skipped_b")) >= 3 * (F.col("n_shingles") + F.col("n_b"))
        fit = (F.col("component") != F.col("component_b")) & (4 * F.least("n_shingles", "n_b") >= 3 * F.greatest("n_shingles", "n_b")) & enough
        near = salted_join(short.select("finer", "node", "n_shingles", "component", "skipped"), others, "finer", crowded, "inner", "node").filter(fit)
        found = settle(star.unionByName(near.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))).distinct(), f"rest-{depth}")
        if last:
            break
        # lists that the new links leave with several components are the groups of the next turn, with the tokens that come after those they are made of
        long = _with_component(mine.filter(F.col("outside") > SHORT).drop("component"), found)
        still = long.groupBy("finer").agg(F.min("component").alias("least"), F.max("component").alias("most")).filter("least < most").select("finer")
        long = scratch.table(salted_join(long, still, "finer", crowded, "inner", "node"), f"long-{depth}")
        scratch.drop(f"mine-{depth}")
        if long.isEmpty():
            break
        later = F.transform(F.filter("common", lambda t: (t["n"] > F.col("n")) | ((t["n"] == F.col("n")) & (t["class"] > F.col("class")))), lambda t: t["token"])
        finer = known.select("group", "node", "common").join(long.select("finer", "group", "node", "n_shingles", "component", "skipped", "matched", F.col("small.n_shingles").alias("floor"), "n", "class"), ["group", "node"])
        finer = scratch.table(finer.select(F.col("finer").alias("group"), "node", "n_shingles", "component", "skipped", "matched", "floor", later.alias("tokens")).filter(F.size("tokens") > 0), f"finer-{depth}")
        scratch.drop(f"common-{depth}")
        state = finer.select("group", "node", "n_shingles", "component", "skipped", "matched", "floor", F.size("tokens").cast("long").alias("remaining"))
        tokens = finer.select("group", "node", F.explode("tokens").alias("token"))
    return found


def _with_component(rows: DataFrame, found: DataFrame) -> DataFrame:
    return rows.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, text_sha256, n_shingles, component_id, kept."""
    with measured_joins(docs.sparkSession):
        return _near_duplicates(id_and_text(docs, id_col, text_col))


def _near_duplicates(texts: DataFrame) -> DataFrame:
    scratch = Scratch(texts.sparkSession, "minhash")
    signed = scratch.table(signatures(texts), "signed")
    named = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    # a node for each distinct set: the least of its rows
    smallest = scratch.table(named.groupBy("set_a", "set_b", "n_shingles").agg(F.min("uid").alias("node"), F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "smallest")
    reps = scratch.table(named.withColumnRenamed("uid", "node").join(smallest.select("node"), "node", "left_semi").select("node", "doc_id", "row", "n_shingles", "signature"), "reps")
    posted = scratch.table(postings(reps, scratch), "posted")
    scratch.drop("shared")
    scratch.release()
    wanted = scratch.table(reps.join(posted.select("node").distinct(), "node", "left_semi").select("node", "doc_id", "row"), "wanted")
    shared = texts.sparkSession.sparkContext.broadcast(bitmap(wanted.select(F.col("row").alias("key"))))
    sets = scratch.table(_sets(texts, wanted, shared), "sets")
    shared.destroy()
    scratch.release()

    found = None

    def settle(pairs: DataFrame, name: str) -> DataFrame:
        """The components by the links among ``pairs`` and those before: a node and its component stand for all links that made them."""
        close = scratch.table(_agreeing(scratch.table(pairs, f"pairs-{name}"), reps), f"close-{name}")
        links = scratch.table(_confirmed(close, sets), f"links-{name}")
        if found is not None:
            links = links.unionByName(found.select(F.col("node").alias("a"), F.col("component").alias("b")))
        out = scratch.table(connected_components(links, scratch, f"star-{name}"), f"components-{name}")
        for done in ("pairs", "close", "links"):
            scratch.drop(f"{done}-{name}")
        scratch.release()
        return out

    live, size = posted, posted.count()
    for turn, pick in enumerate((F.max_by("node", F.struct("weight", -F.col("node"))), F.min("node"))):
        if found is not None:
            live = _with_component(posted, found)
        many = [F.count(F.lit(1)).alias("n"), pick.alias("a")] + ([F.min("component").alias("least"), F.max("component").alias("most")] if found is not None else [])
        lists = scratch.table(live.groupBy("key").agg(*many).filter("n > 1" if found is None else "n > 1 AND least < most"), f"lists-{turn}")
        crowded = lists.filter(F.col("n") * HOT_SHARE >= size).select("key")
        if found is None:
            pairs = salted_join(live, lists.select("key", "a"), "key", hashes_of(crowded, "key"), "inner", "node").filter("a <> node")
        else:
            named_by = found.select(F.col("node").alias("a"), F.col("component").alias("component_a"))
            of_a = lists.select("key", "a").join(named_by, "a", "left").select("key", "a", F.coalesce("component_a", "a").alias("component_a"))
            pairs = salted_join(live, of_a, "key", hashes_of(crowded, "key"), "inner", "node").filter("component_a <> component")
        found = settle(pairs.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct(), str(turn))

    def settled(pairs: DataFrame, name: str) -> DataFrame:
        nonlocal found
        found = settle(pairs, name)
        return found

    found = _across(posted, found, sets, scratch, settled)

    # the smallest document id of each component
    nodes = _with_component(smallest, found)
    crowded = nodes.groupBy("component").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") * HOT_SHARE >= smallest.count()).select("component")
    least = nodes.groupBy("component").agg(F.min("rep").alias("component_id"))
    sets_of = scratch.table(salted_join(nodes, least, "component", crowded, "inner", "node").select(*SET_NAME, "copies", "component_id"), "named")
    key = F.struct(*SET_NAME)
    hot = sets_of.filter(F.col("copies") * HOT_SHARE >= signed.count()).select(key.alias("set"))
    rows = signed.select("doc_id", "text_sha256", "n_shingles", F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), key).alias("set"))
    out = salted_join(rows, sets_of.select(key.alias("set"), "component_id"), "set", hot, "left", "doc_id")
    component = F.coalesce("component_id", "doc_id")
    return scratch.finish(out.select("doc_id", "text_sha256", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept")))
