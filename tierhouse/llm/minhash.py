"""Near-duplicate documents by circulant MinHash, confirmed on full shingle sets.

Two permutations of the 32-bit integers make a whole signature: the first
spreads the shingles, the second, shifted circularly by 0, 1, 2 ..., gives one
coordinate after the other. Bands of coordinates are bucket keys.

Documents with equal sets form a class and only its representative goes on.
In each bucket the member that meets most others in all its buckets is the
hub (in a group of copies that is the original or what comes closest), and
every member is compared with the hub alone, on full sets: one pair for each
member, however large the bucket. Only where that leaves the members in
several components are other pairs looked at. Two members of a bucket can be
alike enough only if what sets one of them apart from the hub sets the other
apart, too, so they meet through those differences, by an exact prefix filter
(`_differences`), and not as all pairs of the bucket. Components are then
joined once more.

Every pair that shares a bucket is thus compared, known to be connected, or
proven too unlike; a pair at the threshold shares none with a probability
below 1e-6 (40 bands of 5).

Defined cases: a text without words and a null text have an empty set and are
linked with nothing; fewer words than a shingle make one shingle; rows of one
id are one document whose every text counts, so what one of its texts is linked
with, all are; a null id has a null component;
an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierhouse.llm.common import Words, mapped, mix64, words_of, written
from tierhouse.llm.components import components

BANDS, ROWS = 40, 5


def shingles(words: Words, width: int) -> list[np.ndarray]:
    """The distinct hashed shingles of each text, sorted."""
    hashes = words.hashes
    factors = mix64(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    count = max(0, len(hashes) - width + 1)
    runs = np.zeros(count, np.uint64)
    for j in range(width):
        runs += hashes[j : j + count] * factors[j]
    runs = mix64(runs)
    out = []
    for a, b in zip(words.first[:-1], words.first[1:]):
        if b - a >= width:
            out.append(np.unique(runs[a : b - width + 1]))
        elif b > a:
            out.append(mix64(np.array([(hashes[a:b] * factors[: b - a]).sum() + np.uint64(b - a)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _second(x: np.ndarray) -> np.ndarray:
    """The second permutation, of 32-bit integers."""
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    x = (x ^ (x >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return x ^ (x >> np.uint32(16))


def signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """One row of coordinates for each (non-empty) set."""
    # Shingle hashes are mixed already: their upper half is the first permutation's image.
    image = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    first = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]]).astype(np.int64)
    out = np.empty((len(sets), coordinates), np.uint32)
    for k in range(coordinates):
        out[:, k] = np.minimum.reduceat(_second(image - np.uint32(k)), first)
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key for each band of each row; the band's number is part of it."""
    parts = signature.reshape(len(signature), bands, rows).astype(np.uint64)
    key = np.broadcast_to(mix64(np.arange(1, bands + 1, dtype=np.uint64)), parts.shape[:2])
    for j in range(rows):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, j])
    return key.view(np.int64)


def sketches(docs: DataFrame, doc_id: str, text: str, width: int, bands: int, rows: int) -> DataFrame:
    """__id, __n (set size), __class (digest of the set, null if empty) and __keys of each row."""

    def measure(texts: pa.Array) -> list:
        sets = shingles(words_of(texts.cast(pa.binary()).to_pylist(), lower=True), width)
        full = [s for s in sets if len(s)]
        keys = iter(band_keys(signatures(full, bands * rows), bands, rows)) if full else iter(())
        return [
            pa.array([len(s) for s in sets], pa.int64()),
            pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
            pa.array([next(keys) if len(s) else None for s in sets], pa.list_(pa.int64())),
        ]

    fields = [("__n", T.LongType()), ("__class", T.BinaryType()), ("__keys", T.ArrayType(T.LongType()))]
    return mapped(docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("__body")), "__body", ["__id"], fields, measure)


def shingle_sets(docs: DataFrame, text: str, keep: list[str], width: int) -> DataFrame:
    """`keep` and the whole __set of each row."""

    def measure(texts: pa.Array) -> list:
        sets = shingles(words_of(texts.cast(pa.binary()).to_pylist(), lower=True), width)
        return [pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))]

    return mapped(docs, text, keep, [("__set", T.ArrayType(T.LongType()))], measure)


def _enough(common: Column, a: Column, b: Column, percent: int) -> Column:
    """100 * common >= percent * (a + b - common), in whole numbers."""
    return (100 + percent) * common >= percent * (a + b)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are alike enough."""
    one = sets.select(F.col("__node").alias("b"), F.col("__set").alias("__b"))
    two = sets.select(F.col("__node").alias("a"), F.col("__set").alias("__a"))
    common = F.size(F.array_intersect("__a", "__b"))
    both = pairs.select("a", "b").join(one, "b").join(two, "a")
    return both.where(_enough(common, F.size("__a"), F.size("__b"), percent)).select("a", "b")


def _crossing(live: DataFrame, hubs: DataFrame, groups: DataFrame) -> DataFrame:
    """(__hub, __node, __group) of the buckets in which members besides the hub are in different components."""
    known = (
        live.join(groups.withColumnRenamed("node", "__node"), "__node", "left")
        .join(hubs, "__key")
        .where(F.col("__node") != F.col("__hub"))
        .select("__key", "__hub", "__node", F.coalesce("component", "__node").alias("__group"))
    )
    mixed = known.groupBy("__key").agg(F.min("__group").alias("lo"), F.max("__group").alias("hi")).where("lo <> hi").select("__key")
    return known.join(mixed, "__key").select("__hub", "__node", "__group").distinct()


def _differences(rest: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Each member with how its set differs from the hub's, as prefixes that a partner must meet.

    With R removed and A added shingles, two members' intersection is the hub's
    size less all their R, plus what their removed and their added shingles
    have in common. To reach the threshold they must share at least
    (W + W' - K) / (100 + percent) differences, W = 100 R + percent A and
    K = (100 - percent) * hub. A member with W <= K is near: linked to the hub,
    hence to all others that are near. So one of a pair is far, and

    - either one shares more than W / (100 + percent) with a far partner,
    - a far one shares at least (W - K) / (100 + percent) with a near partner.

    In any fixed order of differences, here added ones first, two members that
    share s of theirs share one among all but the last s - 1 of each.
    """
    hub = sets.select(F.col("__node").alias("__hub"), F.col("__set").alias("__h"))
    both = rest.join(sets, "__node").join(hub, "__hub")
    added = F.array_sort(F.array_except("__set", "__h"))
    removed = F.array_sort(F.array_except("__h", "__set"))
    made = both.select("__hub", "__node", "__group", F.size("__h").alias("__hubs"), added.alias("__added"), removed.alias("__removed"))
    weight = 100 * F.size("__removed") + percent * F.size("__added")
    slack = (100 - percent) * F.col("__hubs")
    count = F.size("__added") + F.size("__removed")
    with_far = count - F.floor(weight / (100 + percent)).cast("int")
    with_near = count - F.greatest(F.lit(1), F.ceil((weight - slack) / (100 + percent)).cast("int")) + 1
    far = weight > slack
    # Removed shingles are told from added ones by their complement.
    listed = F.concat("__added", F.transform("__removed", lambda x: F.bitwise_not(x)))
    reach = F.when(far, F.greatest(with_far, with_near)).otherwise(with_far)
    return made.select(
        "__hub", "__node", "__group", far.alias("__far"), with_far.alias("__with_far"), with_near.alias("__with_near"),
        count.alias("__count"), weight.alias("__weight"), slack.alias("__slack"),
        F.posexplode(F.slice(listed, F.lit(1), F.greatest(F.lit(0), reach))).alias("__at", "__what"),
    )


def _possible(rest: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of one hub and two components that share enough of their differences to be alike enough."""
    prefixes = written(_differences(rest, sets, percent), "minhash-differences")
    one, two = prefixes.where("__far").alias("l"), prefixes.alias("r")
    # The first difference that two members share leaves no more to share than what follows it in either.
    most = F.least(F.col("l.__count") - F.col("l.__at"), F.col("r.__count") - F.col("r.__at"))
    enough = (100 + percent) * most >= F.col("l.__weight") + F.col("r.__weight") - F.col("l.__slack")
    met = (
        (F.col("l.__hub") == F.col("r.__hub"))
        & (F.col("l.__what") == F.col("r.__what"))
        & (F.col("l.__group") != F.col("r.__group"))
        & F.when(F.col("r.__far"), (F.col("l.__node") < F.col("r.__node")) & (F.col("l.__at") < F.col("l.__with_far"))).otherwise(
            F.col("l.__at") < F.col("l.__with_near")
        )
        & (F.col("r.__at") < F.col("r.__with_far"))
        & enough
    )
    return one.join(two, met).select(F.col("l.__node").alias("a"), F.col("r.__node").alias("b")).distinct()


def linked_groups(classes: DataFrame, docs: DataFrame, doc_id: str, text: str, width: int, percent: int) -> DataFrame:
    """(node, component) of the representatives that have a link."""
    members = classes.select("__node", "__n", F.explode("__keys").alias("__key"))
    buckets = members.groupBy("__key").agg(F.count(F.lit(1)).alias("__count")).where("__count > 1")
    live = written(members.join(buckets, "__key"), "minhash-live")
    met = live.groupBy("__node").agg(F.sum("__count").alias("__met"))
    ranked = live.join(met, "__node").select("__key", "__node", "__n", F.struct((-F.col("__met")).alias("o"), "__node", "__n").alias("__rank"))
    hubs = ranked.groupBy("__key").agg(F.min("__rank").alias("h")).select("__key", F.col("h.__node").alias("__hub"), F.col("h.__n").alias("__hub_n"))
    hubs = written(hubs, "minhash-hubs")
    star = (
        live.join(hubs, "__key")
        .where(F.col("__node") != F.col("__hub"))
        .where(_enough(F.least("__n", "__hub_n"), F.col("__n"), F.col("__hub_n"), percent))
        .select(F.col("__hub").alias("a"), F.col("__node").alias("b"))
        .distinct()
    )
    texts = docs.select(F.col(doc_id).alias("__node"), F.col(text).alias("__body"))
    sets = written(shingle_sets(texts.join(met.select("__node"), "__node"), "__body", ["__node"], width), "minhash-sets")
    links = written(confirmed(star, sets, percent), "minhash-links")
    groups = components(links)
    rest = written(_crossing(live, hubs.drop("__hub_n"), groups), "minhash-rest")
    more = written(confirmed(_possible(rest, sets, percent), sets, percent), "minhash-more")
    if more.isEmpty():
        return groups
    return components(more.unionByName(groups.select(F.col("node").alias("a"), F.col("component").alias("b"))))


def _of_one_id(own: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the representatives of classes that share an id."""
    full = own.where("__n > 0 AND __id IS NOT NULL").select("__id", F.col("__class").alias("__c"))
    several = full.groupBy("__id").agg(F.min("__c").alias("lo"), F.max("__c").alias("hi")).where("lo <> hi").select("__id")
    nodes = full.join(several, "__id").join(classes.select(F.col("__class").alias("__c"), "__node"), "__c").select("__id", "__node").distinct()
    return nodes.join(nodes.groupBy("__id").agg(F.min("__node").alias("a")), "__id").where("a <> __node").select("a", F.col("__node").alias("b"))


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    rows: int = ROWS,
    one_text_per_id: bool = False,
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept. Linked are sets of at least `percent` % Jaccard similarity.

    `one_text_per_id` says that no id has several texts, so that none is looked for.
    """
    own = written(sketches(docs, doc_id, text, width, bands, rows), "minhash-sketches")
    grouped = own.where("__n > 0").groupBy("__class")
    classes = written(
        grouped.agg(F.min("__id").alias("__node"), F.first("__n").alias("__n"), F.first("__keys").alias("__keys")), "minhash-classes"
    )
    groups = linked_groups(classes.where("__node IS NOT NULL"), docs, doc_id, text, width, percent)
    same = None if one_text_per_id else written(_of_one_id(own, classes), "minhash-ids")
    if same is not None and not same.isEmpty():
        groups = components(same.unionByName(groups.select(F.col("node").alias("a"), F.col("component").alias("b"))))
    of_class = classes.join(groups.withColumnRenamed("node", "__node"), "__node", "left").select(
        F.col("__class").alias("__c"), F.coalesce("component", "__node").alias("__component")
    )
    component = F.when(F.col("__n") > 0, F.col("__component")).otherwise(F.col("__id"))
    return own.join(of_class, F.col("__class") == F.col("__c"), "left").select(
        F.col("__id").alias("doc_id"),
        F.col("__n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("__id").eqNullSafe(component).alias("kept"),
    )


def one_of_each(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80, one_per_id: bool = True
) -> DataFrame:
    """The rows that stay, with all their columns: of each component the document of smallest id, once.

    A document here is an id and a text, so rows that share an id with other
    texts are judged by their own; only rows that agree in both are one. With
    `one_per_id` one document of each id stays in the end, the same in each run.
    Rows without an id are kept: nothing can be said to be their copy's name.
    """
    # Of one id's texts a hash is enough to tell them apart.
    own = F.when(F.col(doc_id).isNotNull(), F.struct(F.col(doc_id).alias("id"), F.xxhash64(F.md5(F.col(text)), F.col(text).isNull()).alias("hash")))
    keyed = docs.select(own.alias("__own"), F.col(text).alias("__text"))
    decided = written(near_duplicates(keyed, "__own", "__text", width, percent, one_text_per_id=True), "minhash-decided")
    stay = decided.where("kept AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("__stay")).agg(F.count(F.lit(1)).alias("__times"))
    if one_per_id:
        stay = stay.groupBy("__stay.id").agg(F.min_by(F.struct("__stay", "__times"), "__stay").alias("s")).select("s.*")
    stay = written(stay, "minhash-stay")
    out = docs.withColumn("__own", own).join(stay, F.col("__own") == F.col("__stay"))
    if not stay.where("__times > 1").isEmpty():  # rows that repeat an id and its text
        out = out.dropDuplicates(["__own"])
    return out.select(*docs.columns).unionByName(docs.where(F.col(doc_id).isNull()))
