"""N-gram Jaccard join: candidates must share prefix tokens under several token orders.

1. Every text becomes its set of word shingles.  Equal sets form one class; classes are compared.
2. Order A sorts tokens by hash.  Two similar sets share at least l tokens within their extended
   prefixes (size - least overlap + l), so a class whose prefix holds fewer than l tokens that any
   other class's prefix has too cannot have a partner.  Only the other classes go on.
3. Orders B and C sort by rarity among the classes left, ties by two unrelated hashes.  A pair must
   share a token of both prefixes.  Tokens that only one class has can match nothing; their number
   also bounds the overlap of a pair, which must still reach the threshold.
4. Pairs are verified on the whole sets.

Lists of B tokens are not paired out, or a group of near copies would cost the square of its
size.  Every class is first compared with a centre, the member that most others meet in their lists.
Classes with one centre are then compared by their few differences from it, and share some of the
rarest of those if they are similar (``_links_by_difference``).  What is left are pairs of different
centres: in each round the first members of a list that do not have its usual centre are compared
with those of other centres and components; their number grows eightfold until it exceeds every
list.  Links between two members of one component are not needed, and no other pair is left out.

Tokens travel packed, many to a row, to buckets of bounded size (``packed``); each bucket gets a
token at most once per class and block of text.  Sets are identified by a 64-bit hash of their
sorted 64-bit shingle hashes.

Defined results: null, empty or word-less texts have the empty set and are linked with nothing;
repeated rows are members of one class; rows with a null doc_id are compared like others, but
never name a component unless all its rows have none (then it is null)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civicspark.llm.frames import cut, fresh, named
from civicspark.llm.graph import components
from civicspark.llm.packed import (
    BLOCK_BYTES,
    bucket_count,
    by_bucket,
    merged,
    pack,
    run_starts,
    text_size,
    unpack,
)
from civicspark.llm.tokens import SPACED, gram_hashes, mix, slices, words

#: Extra share of a set's tokens in order A's prefix, and so of the tokens that must be shared.
EXTRA = 0.15
#: Members of a list that are compared with the others in the first round; eight times more in
#: each further round.
PIVOTS = 8

_ROW = "bucket int, payload binary"


def _ceil_share(n, percent: int):
    """Least overlap of a set of ``n`` with any partner."""
    return -(-n * percent // 100)


def _extra(n):
    return np.maximum(1, (n * EXTRA).astype(np.int64))


def _prefix_size(n, percent: int):
    """Order A: size - least overlap + l."""
    return np.minimum(n, n - _ceil_share(n, percent) + _extra(n))


def _must_share(n, percent: int):
    """l of the smallest possible partner."""
    return np.minimum(_extra(_ceil_share(n, percent)), _extra(n))


class Sets:
    """Sorted distinct shingle hashes of every text of a block."""

    def __init__(self, column: pa.Array, shingle: int) -> None:
        found = words(column, SPACED, True)
        texts = len(found.counts)
        hashes = gram_hashes(found.hashes, shingle)
        text = found.text
        whole = (
            text[: len(hashes)] == text[shingle - 1 :] if len(hashes) else np.zeros(0, bool)
        )
        tokens, owner = [hashes[whole]], [text[: len(hashes)][whole]]
        for n in range(1, shingle):
            short = np.flatnonzero(found.counts == n)
            if len(short):
                starts = found.first[short]
                tokens.append(gram_hashes(found.hashes, n)[starts])
                owner.append(short)
        token, owner = np.concatenate(tokens), np.concatenate(owner)
        order = np.lexsort((token, owner))
        token, owner = token[order], owner[order]
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])
        self.tokens, self.owner = token[new], owner[new]
        self.first = np.searchsorted(self.owner, np.arange(texts + 1))
        self.sizes = np.diff(self.first)
        self.keys = np.array([self._key(i) for i in range(texts)], np.int64)

    def of(self, i: int) -> np.ndarray:
        return self.tokens[self.first[i] : self.first[i + 1]]

    def _key(self, i: int) -> int:
        digest = hashlib.blake2b(self.of(i).tobytes(), digest_size=8).digest()
        return int.from_bytes(digest, "little", signed=True)


def _blocks(batches: Iterable[pa.RecordBatch], text: str, shingle: int):
    for batch in batches:
        column = batch.column(text).cast(pa.string())
        for part in slices(column, BLOCK_BYTES):
            rows = batch.slice(part.start, part.stop - part.start)
            yield rows, Sets(column[part], shingle)


def _bucket_rows(keys: np.ndarray, buckets: int, *values: np.ndarray) -> pa.RecordBatch:
    numbers, payloads = [], []
    for number, at in by_bucket(keys, buckets):
        numbers.append(number)
        payloads.append(pack(keys[at], *(v[at] for v in values)))
    return pa.RecordBatch.from_arrays(
        [pa.array(numbers, pa.int32()), pa.array(payloads, pa.binary())], ["bucket", "payload"]
    )


def _set_rows(documents: DataFrame, shingle: int) -> DataFrame:
    """``doc_id, n_shingles, set_key`` of every row; the key is null for the empty set."""

    def sets(batches):
        for rows, found in _blocks(batches, "text", shingle):
            keys = pa.array(found.keys, mask=found.sizes == 0)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(found.sizes, pa.int64()), keys],
                ["doc_id", "n_shingles", "set_key"],
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.mapInArrow(sets, f"doc_id {kind}, n_shingles long, set_key long")


def _distinct(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Entries of a bucket (token, class, ...), sorted by both, without repeats."""
    order = np.lexsort((columns[1], columns[0]))
    token, key = columns[0][order], columns[1][order]
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (key[1:] != key[:-1])
    return [c[order][new] for c in columns]


def _counts(token: np.ndarray) -> np.ndarray:
    starts = run_starts(token)
    sizes = np.diff(np.r_[starts, len(token)])
    return np.repeat(sizes, sizes)


def _spread(keys: np.ndarray) -> np.ndarray:
    return mix(keys.astype(np.int64).view(np.uint64))


def _survivors(documents: DataFrame, shingle: int, percent: int, size: int) -> DataFrame:
    """``set_key`` of the classes that order A leaves."""
    buckets = bucket_count(size / 6 * (1 - percent / 100 + EXTRA))
    groups = bucket_count(size / 2000)

    parts = pa.struct([("tokens", pa.binary()), ("classes", pa.binary())])

    def prefixes(batches):
        for _, found in _blocks(batches, "text", shingle):
            take = np.arange(len(found.tokens)) - found.first[found.owner] < _prefix_size(
                found.sizes, percent)[found.owner]
            owner, tokens = found.owner[take], found.tokens[take]
            numbers, payloads = [], []
            for number, at in by_bucket(tokens, buckets):
                # each class once, and its place in that list with every token
                own, place = np.unique(owner[at], return_inverse=True)
                classes = pack(found.keys[own], found.sizes[own].astype(np.int32))
                payloads.append(
                    {"tokens": pack(tokens[at], place.ravel().astype(np.uint32)), "classes": classes}
                )
                numbers.append(number)
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers, pa.int32()), pa.array(payloads, parts)], ["bucket", "payload"]
            )

    def shared(table: pa.Table) -> pa.Table:
        columns: list[list[np.ndarray]] = [[], [], []]
        for payload in table.column("payload").to_pylist():
            token, place = unpack(payload["tokens"])
            for column, own in zip(columns[1:], unpack(payload["classes"]), strict=True):
                column.append(own[place])
            columns[0].append(token)
        token, key, n = _distinct([np.concatenate(c) for c in columns])
        more = _counts(token) > 1
        key, n = key[more], n[more]
        unique, at, count = np.unique(key, return_index=True, return_counts=True)
        numbers, payloads = [], []
        for number, part in by_bucket(_spread(unique), groups):
            numbers.append(number)
            payloads.append(pack(unique[part], n[at][part], count[part].astype(np.int32)))
        return pa.table(
            {"bucket": pa.array(numbers, pa.int32()), "payload": pa.array(payloads, pa.binary())}
        )

    def enough(table: pa.Table) -> pa.Table:
        key, n, count = merged(table.column("payload").to_pylist())
        unique, at, group = np.unique(key, return_index=True, return_inverse=True)
        total = np.bincount(group, weights=count, minlength=len(unique))
        kept = unique[total >= _must_share(n[at].astype(np.int64), percent)]
        return pa.table({"set_key": pa.array(kept, pa.int64())})

    return (
        documents.select("text")
        .mapInArrow(prefixes, "bucket int, payload struct<tokens: binary, classes: binary>")
        .groupBy("bucket")
        .applyInArrow(shared, _ROW)
        .groupBy("bucket")
        .applyInArrow(enough, "set_key long")
    )


def _class_sets(
    documents: DataFrame, rows: DataFrame, survivors: DataFrame, shingle: int
) -> DataFrame:
    """``set_key, n, tokens`` of the classes left, from one document of each."""
    chosen = (
        rows.join(survivors, "set_key", "left_semi")
        .groupBy("set_key")
        .agg(F.min("doc_id").alias("of"))
    )
    texts = documents.join(chosen, documents["doc_id"].eqNullSafe(chosen["of"])).select(
        "set_key", "text"
    )

    def sets(batches):
        for block, found in _blocks(batches, "text", shingle):
            sought = block.column("set_key").to_numpy()
            same = np.flatnonzero(found.keys == sought)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(sought[same], pa.int64()),
                    pa.array(found.sizes[same], pa.int64()),
                    pa.array([found.of(i).tobytes() for i in same], pa.binary()),
                ],
                ["set_key", "n", "tokens"],
            )

    return texts.mapInArrow(sets, "set_key long, n long, tokens binary")


def _lists(sets: DataFrame, percent: int) -> DataFrame:
    """``set_key, n, own, b, c``: tokens no other class has, prefix tokens of orders B and C."""
    total = sets.agg(F.sum("n")).first()[0] or 0
    buckets = bucket_count(total)

    def tokens(batches):
        for batch in batches:
            sizes = batch.column("n").to_numpy()
            keys = np.repeat(batch.column("set_key").to_numpy(), sizes)
            found = b"".join(v.as_py() for v in batch.column("tokens"))
            yield _bucket_rows(
                np.frombuffer(found, np.uint64), buckets, keys,
                np.repeat(sizes, sizes).astype(np.int32),
            )

    def shared(table: pa.Table) -> pa.Table:
        token, key, n = _distinct(merged(table.column("payload").to_pylist()))
        count = _counts(token)
        more = count > 1
        token, key, n, count = token[more], key[more], n[more], count[more]
        numbers, payloads = [], []
        for number, at in by_bucket(_spread(key), buckets):
            numbers.append(number)
            payloads.append(pack(key[at], token[at], n[at], count[at].astype(np.int32)))
        return pa.table(
            {"bucket": pa.array(numbers, pa.int32()), "payload": pa.array(payloads, pa.binary())}
        )

    def prefixes(table: pa.Table) -> pa.Table:
        key, token, n, count = merged(table.column("payload").to_pylist())
        out: dict[str, list] = {"set_key": [], "n": [], "own": [], "b": [], "c": []}
        tie = {"b": mix(token ^ np.uint64(0xB)), "c": mix(token ^ np.uint64(0xC0FFEE))}
        order = {name: np.lexsort((tie[name], count, key)) for name in tie}
        sorted_key = key[order["b"]]
        starts = run_starts(sorted_key)
        for begin, end in zip(starts, np.r_[starts[1:], len(key)], strict=True):
            size = int(n[order["b"][begin]])
            own = size - (end - begin)
            take = size - int(_ceil_share(size, percent)) + 1 - own
            if take <= 0:
                continue
            out["set_key"].append(int(sorted_key[begin]))
            out["n"].append(size)
            out["own"].append(int(own))
            for name in ("b", "c"):
                part = order[name][begin : min(end, begin + take)]
                out[name].append(token[part].view(np.int64))
        return pa.table(
            {
                "set_key": pa.array(out["set_key"], pa.int64()),
                "n": pa.array(out["n"], pa.int64()),
                "own": pa.array(out["own"], pa.int64()),
                "b": pa.array(out["b"], pa.list_(pa.int64())),
                "c": pa.array(out["c"], pa.list_(pa.int64())),
            }
        )

    return (
        sets.mapInArrow(tokens, _ROW)
        .groupBy("bucket")
        .applyInArrow(shared, _ROW)
        .groupBy("bucket")
        .applyInArrow(prefixes, "set_key long, n long, own long, b array<long>, c array<long>")
    )


def _possible(percent: int) -> Column:
    """Whether sizes and own tokens of a pair allow the similarity."""
    overlap = F.least(F.expr("p.n - p.own"), F.expr("m.n - m.own"))
    return 100 * overlap >= percent * (F.expr("p.n + m.n") - overlap)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole sets are similar enough."""

    def side(name: str) -> DataFrame:
        return sets.select(F.col("set_key").alias(name), F.col("tokens").alias(f"{name}_tokens"))

    def check(batches):
        for batch in batches:
            keep = []
            for one, two in zip(batch.column("x_tokens"), batch.column("y_tokens"), strict=True):
                a = np.frombuffer(one.as_buffer(), np.uint64)
                b = np.frombuffer(two.as_buffer(), np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            kept = batch.filter(pa.array(keep, pa.bool_()))
            yield kept.select(["x", "y"])

    return pairs.join(side("x"), "x").join(side("y"), "y").mapInArrow(check, "x long, y long")


def _differences(lists: DataFrame, sets: DataFrame, members: DataFrame) -> DataFrame:
    """``x, p, n, np, o, gone, extra`` of every class ``x`` that has a centre ``p``: the sizes, the
    overlap, and the tokens that only ``p`` and only ``x`` has.

    The leader of a list is its member with the fewest tokens of its own; the centre of a class is the
    leader that most classes meet.  Centres that share less than half with the class do not help."""
    leaders = members.groupBy("token").agg(F.min(F.struct("own", "set_key")).alias("lead"))
    met = (
        members.join(leaders, "token")
        .select(F.col("set_key").alias("x"), F.col("lead.set_key").alias("p"))
        .distinct()
    )
    met = cut(met)
    fame = met.groupBy("p").agg(F.count("*").alias("fame"))
    centres = (
        met.filter("x != p")
        .join(fame, "p")
        .groupBy("x")
        .agg(F.max(F.struct("fame", "p")).alias("best"))
        .select("x", F.col("best.p").alias("p"))
    )

    def side(name: str) -> DataFrame:
        return sets.select(F.col("set_key").alias(name), F.col("tokens").alias(f"{name}_tokens"))

    def compare(batches):
        for batch in batches:
            columns: dict[str, list] = {c: [] for c in ("n", "np", "o", "gone", "extra")}
            useful = []
            for one, two in zip(batch.column("x_tokens"), batch.column("p_tokens"), strict=True):
                a = np.frombuffer(one.as_buffer(), np.uint64)
                b = np.frombuffer(two.as_buffer(), np.uint64)
                extra = np.setdiff1d(a, b, assume_unique=True).view(np.int64)
                both = len(a) - len(extra)
                useful.append(2 * both >= max(len(a), len(b)))
                gone = np.setdiff1d(b, a, assume_unique=True).view(np.int64) if useful[-1] else []
                columns["n"].append(len(a))
                columns["np"].append(len(b))
                columns["o"].append(both)
                columns["gone"].append(gone)
                columns["extra"].append(extra if useful[-1] else [])
            kinds = [pa.int64()] * 3 + [pa.list_(pa.int64())] * 2
            arrays = [pa.array(v, k) for v, k in zip(columns.values(), kinds, strict=True)]
            row = pa.RecordBatch.from_arrays(
                [batch.column("x"), batch.column("p"), *arrays], ["x", "p", *columns]
            )
            yield row.filter(pa.array(useful, pa.bool_()))

    return (
        centres.join(side("x"), "x")
        .join(side("p"), "p")
        .mapInArrow(
            compare,
            "x long, p long, n long, np long, o long, gone array<long>, extra array<long>",
        )
    )


def _links_by_difference(differences: DataFrame, comps: DataFrame, percent: int) -> DataFrame:
    """``x, y``: the links between classes of one centre p that are in different components.

    The overlap of x and y is o(x) + o(y) - |p| + s, where s counts the tokens of p that both lack
    and those outside p that both have.  With ``excess(x) = t n - (100 + t) o + t |p|``, above 0 for
    a class without a link to p, and ``far(y) = t n - (100 + t) o + 100 |p|``, they are linked when
    (100 + t) s >= excess(x) + far(y).  One of the two has no link to p, or both were in p's
    component.  So s of any partner is at least excess(x) / 100, and at least
    (far(y) + smallest excess) / (100 + t): prefix lengths for the differences, rarest first."""
    t = percent
    placed = (
        differences.join(comps.withColumnRenamed("node", "x"), "x", "left")
        .withColumn("comp", F.coalesce("comp", "x"))
        .withColumn("excess", F.expr(f"{t} * n - {100 + t} * o + {t} * np"))
        .withColumn("far", F.expr(f"{t} * n - {100 + t} * o + 100 * np"))
        .withColumn("d", F.expr("size(gone) + size(extra)"))
    )
    alone = placed.filter("excess > 0").groupBy("p").agg(F.min("excess").alias("least"))
    placed = (
        placed.join(alone, "p")
        .withColumn("must", F.expr(f"ceil((far + least) / {100 + t})"))
        .withColumn(
            "must",
            F.when(F.col("excess") > 0, F.least("must", F.ceil(F.col("excess") / 100))).otherwise(
                F.col("must")
            ),
        )
        .withColumn("take", F.expr("d - greatest(must, 1L) + 1"))
        .filter("take > 0")
    )
    placed = cut(placed)
    tokens = placed.select(
        "x", "p", "n", "o", "comp", "excess", "far", "take",
        F.size("gone").alias("r"), F.size("extra").alias("a"),
        F.explode(
            F.concat(
                F.transform("gone", lambda v: F.struct(v.alias("token"), F.lit(0).alias("side"))),
                F.transform("extra", lambda v: F.struct(v.alias("token"), F.lit(1).alias("side"))),
            )
        ).alias("part"),
    ).select("*", "part.token", "part.side").drop("part")
    counts = tokens.groupBy("p", "token", "side").agg(F.count("*").alias("many"))
    rarest = Window.partitionBy("x").orderBy("many", "side", "token")
    kept = (
        tokens.join(counts, ["p", "token", "side"])
        .withColumn("rank", F.row_number().over(rarest))
        .filter("rank <= take AND many > 1")
    )
    kept = cut(kept)
    pairs = (
        kept.filter("excess > 0")
        .alias("u")
        .join(
            kept.alias("v"),
            F.expr(
                "u.p = v.p AND u.token = v.token AND u.side = v.side AND u.comp != v.comp "
                "AND (v.excess <= 0 OR u.x < v.x) "
                f"AND {100 + t} * (least(u.r, v.r) + least(u.a, v.a)) >= u.excess + v.far"
            ),
        )
        .select(F.col("u.x").alias("x"), F.col("v.x").alias("y"))
        .distinct()
    )
    half = placed.select("x", "excess", "far", "gone", "extra")
    one = half.select(*(F.col(c).alias(f"one_{c}") for c in half.columns))
    two = half.select(*(F.col(c).alias(f"two_{c}") for c in half.columns))
    shared = F.size(F.array_intersect("one_gone", "two_gone")) + F.size(
        F.array_intersect("one_extra", "two_extra")
    )
    return (
        pairs.join(one, F.col("x") == F.col("one_x"))
        .join(two, F.col("y") == F.col("two_x"))
        .filter((100 + t) * shared >= F.col("one_excess") + F.col("two_far"))
        .select("x", "y")
    )


def _links(lists: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``node, comp`` of the classes that have a link."""
    members = lists.select("set_key", "n", "own", F.explode("b").alias("token"))
    differences = cut(_differences(lists, sets, members))
    near = differences.filter(F.expr(f"100 * o >= {percent} * (n + np - o)"))
    comps = components(near.select("x", F.col("p").alias("y")))
    found = cut(_links_by_difference(differences, comps, percent))
    comps = components(found.unionByName(comps.toDF("x", "y")))

    centres = differences.select(F.col("x").alias("set_key"), F.col("p").alias("centre"))
    members = cut(
        members.join(centres, "set_key", "left").withColumn(
            "centre", F.coalesce("centre", "set_key")
        )
    )
    tested = differences.select(F.least("x", "p").alias("x"), F.greatest("x", "p").alias("y"))
    orders = lists.select("set_key", "c")
    pivots = PIVOTS
    while True:
        placed = members.join(
            comps.withColumnRenamed("node", "set_key"), "set_key", "left"
        ).withColumn("comp", F.coalesce("comp", "set_key"))
        mostly = (
            placed.groupBy("token", "centre")
            .agg(F.count("*").alias("many"), F.min("comp").alias("a"), F.max("comp").alias("b"))
            .groupBy("token")
            .agg(
                F.max(F.struct("many", "centre")).alias("top"),
                F.sum("many").alias("size"),
                F.min("a").alias("a"),
                F.max("b").alias("b"),
            )
            .filter("a != b AND size > top.many")
            .select("token", F.col("top.centre").alias("usual"), F.expr("size - top.many AS others"))
        )
        placed = cut(placed.join(mostly, "token"))
        most = placed.agg(F.max("others")).first()[0]
        if most is None:
            return comps
        first = Window.partitionBy("token").orderBy("own", "set_key")
        leaders = (
            placed.filter("centre != usual")
            .withColumn("rank", F.row_number().over(first))
            .filter(F.col("rank") <= pivots)
        )
        pairs = (
            leaders.alias("p")
            .join(
                placed.alias("m"),
                F.expr("p.token = m.token AND p.comp != m.comp AND p.centre != m.centre")
                & _possible(percent),
            )
            .select(
                F.least("p.set_key", "m.set_key").alias("x"),
                F.greatest("p.set_key", "m.set_key").alias("y"),
            )
            .distinct()
            .join(tested, ["x", "y"], "left_anti")
            .join(orders.toDF("x", "x_c"), "x")
            .join(orders.toDF("y", "y_c"), "y")
        )
        pairs = cut(pairs.filter(F.arrays_overlap("x_c", "y_c")).select("x", "y"))
        links = cut(_verified(pairs, sets, percent))
        tested = tested.unionByName(pairs)
        comps = components(links.unionByName(comps.toDF("x", "y")))
        if most <= pivots:
            return comps
        pivots *= 8


def similar_groups(
    documents: DataFrame, shingle: int = 5, percent: int = 80
) -> DataFrame:
    """``doc_id, n_shingles, set_key, component_id, comp`` of every row of ``documents`` (which has
    doc_id and text).  Texts link when 100 * intersection >= percent * union of their sets."""
    documents = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = cut(_set_rows(documents, shingle))
    size = text_size(documents)
    survivors = cut(_survivors(documents, shingle, percent, size))
    sets = cut(_class_sets(documents, rows, survivors, shingle))
    lists = cut(_lists(sets, percent))
    comps = _links(lists, sets, percent)
    classes = (
        rows.filter("set_key IS NOT NULL")
        .groupBy("set_key")
        .agg(F.min("doc_id").alias("first_doc"))
        .join(comps.withColumnRenamed("node", "set_key"), "set_key", "left")
        .withColumn("comp", F.coalesce("comp", "set_key"))
    )
    ids = classes.groupBy("comp").agg(F.min("first_doc").alias("component_id"))
    named_classes = classes.join(ids, "comp").select("set_key", "comp", "component_id")
    return rows.join(named_classes, "set_key", "left").select(
        "doc_id",
        "n_shingles",
        "set_key",
        "comp",
        F.when(F.col("set_key").isNull(), F.col("doc_id"))
        .otherwise(F.col("component_id"))
        .alias("component_id"),
    )


def one_of_each(documents: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``documents``, all columns, one of each group of similar texts: the one with the
    smallest doc_id (null after all others).  Texts without words all stay."""
    (key,) = fresh(documents, "set_key")
    groups = cut(
        similar_groups(documents, shingle, percent)
        .filter("set_key IS NOT NULL")
        .select("doc_id", "set_key", "comp")
    )
    first = groups.groupBy("comp").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "set_key")).alias("row")
    )
    kept = first.select(
        F.col("row.doc_id").alias("kept_id"), F.col("row.set_key").alias("kept_key")
    )
    same_row = groups["doc_id"].eqNullSafe(F.col("kept_id")) & (groups["set_key"] == F.col("kept_key"))
    repeated = (
        groups.join(kept, same_row, "left_semi")
        .groupBy("doc_id", "set_key")
        .count()
        .filter("count > 1")
    )
    schema = documents.select("*", F.lit(None).cast("long").alias(key)).schema

    def keyed(batches):
        for rows, found in _blocks(batches, "text", shingle):
            keys = pa.array(found.keys, mask=found.sizes == 0)
            yield pa.RecordBatch.from_arrays([*rows.columns, keys], [*rows.schema.names, key])

    rows = documents.mapInArrow(keyed, schema)
    columns = [named(c) for c in documents.columns]
    found = rows.join(
        kept, rows["doc_id"].eqNullSafe(F.col("kept_id")) & (rows[key] == F.col("kept_key")), "left"
    ).filter(rows[key].isNull() | F.col("kept_key").isNotNull())
    if repeated.isEmpty():
        return found.select(*columns)
    with_words = found.filter(F.col("kept_key").isNotNull()).dropDuplicates(["kept_id", "kept_key"])
    return with_words.select(*columns).unionByName(
        found.filter(F.col("kept_key").isNull()).select(*columns)
    )
