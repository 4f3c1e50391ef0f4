"""Exact word n-gram Jaccard join, size-aware: subsets for small sets, inverted lists for large ones.

1. Each text becomes a set of hashed shingles; equal sets are one node.
2. A shingle that only one text holds can be in no intersection. A first
   exchange counts a quarter of all shingles, a second one all shingles of the
   texts that are left; texts with too many lone shingles leave.
3. Sets up to a boundary size enumerate their subsets of the fixed sizes that a
   partner must share; the others put the rarest part of their shingles into
   inverted lists. The boundary is where enumerating starts to cost more.
4. Lists are scanned for partners: first towards one leader a list, so a group
   of copies costs one comparison a member, then for all pairs whose members
   are still apart. Lists with many such pairs are heavy: the sets of a heavy
   family are compared block by block, and only links leave a block. Every
   candidate is compared in full.

All thresholds are compared in integers, so no link is lost or invented but by
a collision of 64-bit hashes inside one comparison.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphmill.llm._bytes import bucket_bits, bucket_runs, grams, hash_words, mix, slices, split_words, tidied, tidied_group, utf8
from glyphmill.llm._spark import BROADCAST_KEYS, connected_components, forest, join_lists, keep, match_keys, settled, shared_dir


@dataclass(frozen=True)
class JaccardParams:
    shingle: int = 4
    #: Link when 100 * intersection >= percent * union.
    percent: int = 85
    #: One of this many shingles is counted in the first exchange (a power of two).
    sample: int = 4
    #: Largest boundary that is considered for the subsets.
    max_boundary: int = 24
    #: UTF-8 bytes of text in one map-side chunk, and entries of a counting task, about.
    chunk_bytes: int = 8 << 20
    entries_per_bucket: int = 1 << 20
    #: Partitions of the counting exchanges, at most; more buckets share them.
    max_partitions: int = 1 << 15
    #: Lists in which more pairs than this are still apart are compared family by family, in blocks of so many sets.
    heavy_list: int = 1 << 12
    family_block: int = 512
    #: Lists of at most so many entries are always joined by key.
    light_list: int = 1 << 10
    #: Rounds of comparisons with leaders before all remaining pairs are compared.
    leader_rounds: int = 2


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    """Each text's sorted distinct shingle hashes; with fewer than k words the whole sequence is one shingle."""
    start, end, first = split_words(data, offsets)
    h = hash_words(data, start, end, lower=True)
    whole = grams(h, k)
    short = {n: grams(h, n) for n in range(1, k)}
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        n = b - a
        out.append(np.unique(whole[a : b - k + 1]) if n >= k else short[n][a : a + 1] if n else np.zeros(0, np.uint64))
    return out


def _dead_limit(n, percent: int):
    """Shingles that a set of n may lack in an intersection and still link."""
    return n - -(-percent * n // 100)


def _overlap(a: int, b: int, percent: int) -> int:
    """Smallest intersection of linked sets of a and b."""
    return -(-percent * (a + b) // (100 + percent))


def subset_sizes(n: int, percent: int) -> list[int]:
    """The intersection sizes that a set of n needs with its possible partners."""
    low, high = -(-percent * n // 100), 100 * n // percent
    return sorted({c for m in range(max(1, low), high + 1) if (c := _overlap(n, m, percent)) <= min(n, m)})


def subset_cost(n: int, percent: int) -> int:
    return sum(math.comb(n, c) for c in subset_sizes(n, percent))


def prefix_length(n, percent: int):
    """Shingles of a set of n, lone ones first and then the rarest, of which a partner has at least one."""
    return np.minimum(n, _dead_limit(n, percent) + 1)


def subset_signatures(tokens: np.ndarray, percent: int) -> np.ndarray:
    """A hash of every subset of the fixed sizes of a small set."""
    values, out = mix(tokens + np.uint64(0xA5)), []
    for c in subset_sizes(len(tokens), percent):
        chosen = np.array(list(itertools.combinations(range(len(tokens)), c)))
        out.append(mix(values[chosen].sum(axis=1, dtype=np.uint64) + np.uint64(c)))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


_LOCAL = np.uint32(1 << 31)


def _count_entries(sets: list[np.ndarray], step: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, notes) of a chunk: a lone shingle has its text's index, one that more texts hold their number with the top bit."""
    if not sets:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    all_, owner = np.concatenate(sets), np.repeat(np.arange(len(sets), dtype=np.uint32), [len(s) for s in sets])
    if step > 1:
        some = (all_ & np.uint64(step - 1)) == 0
        all_, owner = all_[some], owner[some]
    order = np.argsort(all_)
    all_, owner = all_[order], owner[order]
    heads = np.flatnonzero(np.concatenate(([True], all_[1:] != all_[:-1]))) if len(all_) else np.zeros(0, np.int64)
    many = np.diff(np.append(heads, len(all_)))
    return all_[heads], np.where(many > 1, _LOCAL | many.astype(np.uint32), owner[heads])


def _chunks(batches, limit: int):
    held, size = [], 0
    for batch in batches:
        for part in slices(batch, "t", limit):
            held.append(part)
            size += part.nbytes
            if size >= limit:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


_EXCHANGE = "bucket long, chunk long, kind int, a binary, b binary"
_REPLY = "chunk long, kind int, a binary, b binary"
_SETS, _LONE, _LIVE = 0, 1, 2


def _exchange(texts: DataFrame, p: JaccardParams, step: int, with_sets: bool, entries: int) -> DataFrame:
    """Chunks' sets with the number of lone shingles of each text and, with_sets, its rarest other shingles.

    texts: (key, t). Returns rows (key, n, high, low, dead, tokens, prefix): tokens
    and prefix only with_sets. Chunks are numbered by task, so the input must
    be a scan or a written table, which gives a repeated task the same rows.
    """
    bits = bucket_bits(entries, p.entries_per_bucket)

    def deal(batches):
        task = TaskContext.get().partitionId()
        for number, table in enumerate(_chunks(batches, p.chunk_bytes)):
            chunk = (task << 24) | number
            sets = []
            for part in slices(table.combine_chunks(), "t"):
                sets += shingle_sets(*utf8(part.column("t")), p.shingle)
            hashes, notes = _count_entries(sets, step)
            # the lowest bits chose the sample, so buckets go by the highest
            full, cuts = bucket_runs(hashes, bits)
            rows = {"bucket": full.tolist(), "chunk": [chunk] * len(full), "kind": [_LONE] * len(full), "a": [x.tobytes() for x in np.split(hashes, cuts)] if len(full) else [], "b": [x.tobytes() for x in np.split(notes, cuts)] if len(full) else []}
            n = np.array([len(s) for s in sets], np.int64)
            prints = np.array([np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64) for s in sets], np.int64).reshape(-1, 2)
            head = np.concatenate((table.column("k").to_numpy(), n, prints[:, 0], prints[:, 1])).astype(np.int64).tobytes()
            rows["bucket"].append(-1 - chunk % (1 << bits))
            rows["chunk"].append(chunk)
            rows["kind"].append(_SETS)
            rows["a"].append(head)
            rows["b"].append(np.concatenate(sets).tobytes() if with_sets and sets else b"")
            yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("kind", pa.int32()), ("a", pa.binary()), ("b", pa.binary())]))

    reply = pa.schema([("chunk", pa.int64()), ("kind", pa.int32()), ("a", pa.binary()), ("b", pa.binary())])

    def count(table: pa.Table) -> pa.Table:
        if table.column("bucket")[0].as_py() < 0:
            return table.select(["chunk", "kind", "a", "b"]).cast(reply)
        chunks = table.column("chunk").to_numpy()
        parts = [np.frombuffer(raw.as_py(), np.uint64) for raw in table.column("a")]
        hashes = np.concatenate(parts)
        notes = np.concatenate([np.frombuffer(raw.as_py(), np.uint32) for raw in table.column("b")])
        owner = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
        order = np.argsort(hashes, kind="stable")
        hashes, notes, owner = hashes[order], notes[order], owner[order]
        heads = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))
        texts_of = np.where(notes >= _LOCAL, notes ^ _LOCAL, 1).astype(np.int64)
        many = np.add.reduceat(texts_of, heads)
        spread = np.repeat(many, np.diff(np.append(heads, len(hashes))))
        rows = {"chunk": [], "kind": [], "a": [], "b": []}

        def send(kind: int, mask: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
            by = np.argsort(owner[mask], kind="stable")
            own, a, b = owner[mask][by], a[mask][by], b[mask][by]
            cuts = np.flatnonzero(np.diff(own)) + 1
            for o, x, y in zip(own[np.concatenate(([0], cuts))] if len(own) else [], np.split(a, cuts), np.split(b, cuts)):
                if kind == _LONE:
                    x, y = np.unique(x, return_counts=True)
                rows["chunk"].append(int(chunks[o]))
                rows["kind"].append(kind)
                rows["a"].append(x.tobytes())
                rows["b"].append(y.astype(np.int64).tobytes())

        if with_sets:
            send(_LIVE, spread > 1, hashes, spread)
        else:
            send(_LONE, spread == 1, notes, spread)
        return pa.Table.from_pydict(rows, schema=reply)

    out = "k long, n long, high long, low long, dead long" + (", tokens binary, prefix array<long>" if with_sets else "")

    def merge(table: pa.Table) -> pa.Table:
        kinds = table.column("kind").to_numpy()
        a, b = table.column("a"), table.column("b")
        at = int(np.flatnonzero(kinds == _SETS)[0])
        k, n, high, low = np.frombuffer(a[at].as_py(), np.int64).reshape(4, -1)
        dead = np.zeros(len(k), np.int64)
        for i in np.flatnonzero(kinds == _LONE):
            dead[np.frombuffer(a[int(i)].as_py(), np.uint32)] += np.frombuffer(b[int(i)].as_py(), np.int64)
        columns = {"k": k, "n": n, "high": high, "low": low, "dead": dead}
        if not with_sets:
            return pa.table(columns)
        found = [(np.frombuffer(a[int(i)].as_py(), np.uint64), np.frombuffer(b[int(i)].as_py(), np.int64)) for i in np.flatnonzero(kinds == _LIVE)]
        live = np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.uint64)
        texts_of = np.concatenate([f[1] for f in found]) if found else np.zeros(0, np.int64)
        by = np.argsort(live)
        live, texts_of = np.append(live[by], np.uint64(0)), np.append(texts_of[by], 0)
        sets = np.frombuffer(b[at].as_py(), np.uint64)
        place = np.minimum(np.searchsorted(live[:-1], sets), len(live) - 1)
        times = np.where(live[place] == sets, texts_of[place], 0)  # 0: a lone shingle
        cuts = np.concatenate(([0], np.cumsum(n)))
        alive = np.concatenate(([0], np.cumsum(times > 0)))
        columns["dead"] = dead = n - (alive[cuts[1:]] - alive[cuts[:-1]])
        stay = np.flatnonzero(dead <= _dead_limit(n, p.percent))
        tokens, prefix = [], []
        for d in stay.tolist():
            own, often = sets[cuts[d] : cuts[d + 1]], times[cuts[d] : cuts[d + 1]]
            rare_first = np.lexsort((own, often))
            tokens.append(own.tobytes())
            prefix.append(own[rare_first[int(dead[d]) : int(prefix_length(n[d], p.percent))]].view(np.int64))
        return pa.table({c: v[stay] for c, v in columns.items()} | {"tokens": pa.array(tokens, pa.binary()), "prefix": pa.array(prefix, pa.list_(pa.int64()))})

    dealt = texts.mapInArrow(tidied(deal), _EXCHANGE)
    counted = dealt.repartition(min(1 << bits, p.max_partitions), "bucket").groupBy("bucket").applyInArrow(tidied_group(count), _REPLY)
    return counted.groupBy("chunk").applyInArrow(tidied_group(merge), out)


def _verify(pairs: DataFrame, sets: DataFrame, p: JaccardParams) -> DataFrame:
    """The pairs (a, b) whose sets link."""
    left = sets.select(F.col("k").alias("a"), F.col("tokens").alias("x"))
    right = sets.select(F.col("k").alias("b"), F.col("tokens").alias("y"))

    def compare(batches):
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = np.concatenate((x, y))
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                linked.append(100 * common >= p.percent * (len(x) + len(y) - common))
            keep_ = pa.array(linked, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep_), batch.column("b").filter(keep_)], ["a", "b"])

    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(tidied(compare), "a long, b long")


def _compare_families(family: DataFrame, sets: DataFrame, p: JaccardParams) -> DataFrame:
    """Links (a, b) among each family's members that are in different components; one side is outside the main one.

    Outsiders and members of the main component are cut into blocks of their
    own by a hash of the key. A block of outsiders meets all blocks, one of
    the main component only those of outsiders, so the cost is the family's
    size times its outsiders, and no task holds a family; overlaps are
    products of 0/1 matrices. Of a pair of blocks only as many links leave as
    connect what they connect.
    """
    outside = F.col("component") != F.col("main")
    sizes = family.groupBy("main").agg(F.ceil(F.count(F.when(outside, 1)) / p.family_block).cast("int").alias("outer"), F.ceil(F.count(F.when(~outside, 1)) / p.family_block).cast("int").alias("inner"))
    # blocks 0 to outer - 1 are outsiders'; the main component's follow
    block = F.when(outside, F.pmod(F.xxhash64("k"), F.col("outer"))).otherwise(F.col("outer") + F.pmod(F.xxhash64("k"), F.greatest(F.col("inner"), F.lit(1)))).cast("int")
    placed = family.join(sizes, "main").where("outer > 0").withColumn("own", block)
    partners = F.when(F.col("own") < F.col("outer"), F.sequence(F.lit(0), F.col("outer") + F.col("inner") - 1)).otherwise(F.sequence(F.lit(0), F.col("outer") - 1))
    met = placed.withColumn("other", F.explode(partners))
    met = met.select("main", "k", "component", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    rows = met.join(sets.select("k", "tokens"), "k")

    def compare(table: pa.Table) -> pa.Table:
        i, j, main = (table.column(c)[0].as_py() for c in ("i", "j", "main"))
        k, own, component = (table.column(c).to_numpy() for c in ("k", "own", "component"))
        parts = [np.frombuffer(x.as_py(), np.uint64) for x in table.column("tokens")]
        n = np.array([len(x) for x in parts])
        rows_of = np.repeat(np.arange(len(parts)), n)
        _, place, many = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        shared = many[place] > 1
        column = (np.cumsum(many > 1) - 1)[place[shared]]
        rows_of = rows_of[shared]
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        overlap = np.zeros((len(left), len(right)), np.float32)
        by = np.argsort(column, kind="stable")
        column, rows_of = column[by], rows_of[by]
        for low in range(0, int((many > 1).sum()), 2048):
            x, y = np.searchsorted(column, (low, low + 2048))
            dense = np.zeros((len(parts), 2048), np.float32)
            dense[rows_of[x:y], column[x:y] - low] = 1
            overlap += dense[left] @ dense[right].T
        union = n[left][:, None] + n[right][None, :] - overlap
        linked = (100 * overlap >= p.percent * union) & (component[left][:, None] != component[right][None, :])
        linked &= (component[left] != main)[:, None] | (component[right] != main)[None, :]
        a, b = np.nonzero(linked)
        root = forest(len(k), np.stack((left[a], right[b]), axis=1))
        moved = np.flatnonzero(root != np.arange(len(k)))
        return pa.table({"a": k[moved], "b": k[root[moved]]})

    return rows.groupBy("main", "i", "j").applyInArrow(tidied_group(compare), "a long, b long")


def jaccard_components(docs: DataFrame, params: JaccardParams = JaccardParams(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row.

    component_id is the smallest key reachable by links, the row's own
    included. A null, empty or wordless text has no shingles and links with
    nothing. Rows that repeat a key are one node; rows with a null key link
    with nothing and have a null component. Ties cannot matter, as a component
    does not depend on the order of comparisons. An empty table gives no rows;
    other columns are ignored; long texts are taken whole. Chunks are numbered
    by task, so an input that is no plain scan is written to the shared folder
    first.
    """
    p, spark = params, docs.sparkSession
    at = shared_dir(spark, "jaccard")
    docs = settled(docs.select(F.col(key), F.col(text)), f"{at}/input")
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    words = size // 6
    texts = docs.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))
    sets1 = keep(_exchange(texts, p, p.sample, False, words // p.sample), f"{at}/counted")
    # sets that occur once are their own representatives; of the others one hot set may hold a third of all rows
    same = keep(sets1.where("n > 0").groupBy("high", "low", "n").agg(F.min("k").alias("rep"), F.count(F.lit(1)).alias("c")).where("c > 1"), f"{at}/same")
    same = same.drop("c") if same.count() > BROADCAST_KEYS else F.broadcast(same.drop("c"))
    nodes = keep(sets1.join(same, ["high", "low", "n"], "left").select("k", "n", "dead", F.coalesce("rep", "k").alias("rep")), f"{at}/nodes")
    left = nodes.where((F.col("n") > 0) & (F.col("k") == F.col("rep")) & (100 * (F.col("n") - F.col("dead")) >= p.percent * F.col("n"))).select("k").distinct()
    again = keep(match_keys(texts, keep(left, f"{at}/left"), "k", "left_semi"), f"{at}/again", compression="zstd")
    rest = again.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    sets = keep(_exchange(again, p, 1, True, rest // 6).dropDuplicates(["k", "high", "low"]), f"{at}/sets")

    def signatures(batches):
        for batch in batches:
            k, out = batch.column("k").to_numpy(), [subset_signatures(np.frombuffer(x.as_py(), np.uint64), p.percent) for x in batch.column("tokens")]
            m = [len(x) for x in out]
            all_ = np.concatenate(out) if out else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(all_.view(np.int64)), pa.array(np.repeat(k, m)), pa.array(np.repeat(batch.column("n").to_numpy(), m)), pa.array(np.repeat(batch.column("dead").to_numpy(), m))], ["tok", "k", "n", "dead"])

    lists = sets.select(F.explode("prefix").alias("tok"), "k", "n", "dead")
    spread = lists.groupBy("tok").count().agg((F.sum(F.col("count") * F.col("count")) / F.sum("count")).alias("length")).first()["length"] or 1.0
    boundary = 0
    for n in range(1, p.max_boundary + 1):  # the first size whose subsets cost more than scanning its lists ends the small sets
        if subset_cost(n, p.percent) > float(prefix_length(n, p.percent)) * max(2.0, spread):
            break
        boundary = n
    small = sets.where(F.col("n") <= boundary).select("k", "n", "dead", "tokens").mapInArrow(tidied(signatures), "tok long, k long, n long, dead long")
    large = lists.where(100 * F.col("n") >= p.percent * (boundary + 1))
    postings = large.unionByName(small)
    # one list may hold a third of all sets: longer lists than `most`, at most BROADCAST_KEYS of them, are joined by broadcast
    lengths = keep(postings.groupBy("tok").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), f"{at}/lengths")
    entries = lengths.agg(F.sum("c")).first()[0] or 0
    most = max(p.light_list, entries // BROADCAST_KEYS)
    postings = keep(join_lists(postings, lengths, "tok", most), f"{at}/postings")

    def fits(a: str, b: str, lone_a: str, lone_b: str):
        # an intersection has no lone shingle of either side
        most = F.least(F.col(a) - F.col(lone_a), F.col(b) - F.col(lone_b))
        return (100 + p.percent) * most >= p.percent * (F.col(a) + F.col(b))

    links, tried = None, None
    labels = sets.select("k", F.col("k").alias("component")).distinct()
    # a leader is the member with the smallest share of lone shingles
    rank = F.struct((1000 * F.col("dead") / F.col("n")).cast("int").alias("lone"), F.col("k").alias("leader"), F.col("n").alias("m"), F.col("dead").alias("lm"))
    leaders = keep(postings.groupBy("tok").agg(F.min(rank).alias("top"), F.first("c").alias("c")).select("tok", "c", "top.leader", "top.m", "top.lm"), f"{at}/leaders")
    votes = keep(join_lists(postings.drop("c"), leaders, "tok", most).where((F.col("k") != F.col("leader")) & fits("n", "m", "dead", "lm")).groupBy("k", "leader").agg(F.count(F.lit(1)).alias("votes")), f"{at}/votes")
    for turn in range(p.leader_rounds):
        open_ = votes.join(labels.withColumnRenamed("component", "ca"), "k").join(labels.select(F.col("k").alias("leader"), F.col("component").alias("cb")), "leader").where("ca <> cb")
        if tried is not None:
            open_ = open_.join(tried, (F.col("k") == F.col("a")) & (F.col("leader") == F.col("b")), "left_anti")
        best = open_.groupBy("k").agg(F.max(F.struct("votes", (-F.col("leader")).alias("minus"))).alias("v")).select(F.col("k").alias("a"), (-F.col("v.minus")).alias("b"))
        best = keep(best, f"{at}/tried{turn}")
        tried = best if tried is None else tried.unionByName(best)
        found = keep(_verify(best, sets, p), f"{at}/links{turn}")
        links = found if links is None else links.unionByName(found)
        reached = connected_components(spark, links)
        labels = sets.select("k").distinct().join(reached, F.col("k") == F.col("id"), "left").select("k", F.coalesce("component", "k").alias("component"))

    # what is still apart: in each list, members outside its main component meet all others
    labelled = postings.drop("c").join(labels, "k")
    shares = labelled.groupBy("tok", "component").agg(F.count(F.lit(1)).alias("n"))
    main = shares.groupBy("tok").agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("c"), F.count(F.lit(1)).alias("parts")).where("parts > 1").select("tok", "c", F.col("top.component").alias("main"))
    mixed = keep(join_lists(labelled, keep(main, f"{at}/main"), "tok", most).drop("c"), f"{at}/mixed")
    weights = mixed.groupBy("tok").agg((F.count(F.lit(1)) * F.sum((F.col("component") != F.col("main")).cast("long"))).alias("open"))
    heavy = weights.where(F.col("open") > p.heavy_list).select("tok")
    family = mixed.join(heavy, "tok", "left_semi").groupBy("main", "k").agg(F.max("component").alias("component"))
    rest_links = _compare_families(family, sets, p)
    mixed = mixed.join(heavy, "tok", "left_anti")
    outside = mixed.where("component <> main").select("tok", F.col("k").alias("a"), F.col("n").alias("na"), F.col("component").alias("ca"), F.col("dead").alias("la"))
    others = mixed.select("tok", F.col("k").alias("b"), F.col("n").alias("nb"), F.col("component").alias("cb"), F.col("dead").alias("lb"), F.col("main").alias("m"))
    # a pair of two outsiders would come twice
    once = (F.col("cb") == F.col("m")) | (F.col("a") < F.col("b"))
    pairs = outside.join(others, "tok").where((F.col("ca") != F.col("cb")) & once & fits("na", "nb", "la", "lb"))
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    seen = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    found = keep(_verify(pairs.join(seen, ["a", "b"], "left_anti"), sets, p).unionByName(rest_links), f"{at}/links_rest")
    final = connected_components(spark, links.unionByName(found))
    joined = nodes.join(final.select(F.col("id").alias("rep"), "component"), "rep", "left")
    result = joined.select(F.col("k").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"))
    repeats = result.groupBy("doc_id").agg(F.min("component_id").alias("least"))
    nulls = docs.where(F.col(key).isNull()).select(F.lit(None).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"))
    return result.join(repeats, "doc_id").select("doc_id", "n_shingles", F.col("least").alias("component_id")).unionByName(nulls)


def op2_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
