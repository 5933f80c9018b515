"""Near-duplicate documents by b-bit MinHash.

Every document gets one minimum per hash function over its word shingles. Runs
of minima form bands; documents that share a band are candidates. Of each
minimum only the low bits are kept, packed into 64-bit words: two signatures are
compared by counting equal lanes, and the share of lanes that agree by chance
(2^-bits) is taken out. Candidates that could reach the threshold are confirmed
on their full shingle sets, and confirmed links are joined into components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.components import connected_components
from strata.llm.names import unused
from strata.llm.words import mix, shingle_set, utf8, word_hashes
from strata.sources import layer_path, scratch_dir, write_layer


@dataclass(frozen=True)
class NearDuplicates:
    """What counts as a near duplicate, and how candidates are found.

    Sets of ``width``-word shingles are linked when ``denominator * intersection
    >= numerator * union``. With ``bands`` of ``rows`` minima a pair at similarity
    s is missed by the bands with probability ``(1 - s**rows)**bands``: 3e-6 at
    0.8 and 7e-9 at 0.85. ``slack`` is how many standard errors an estimate may
    fall short of the threshold before a candidate is dropped unconfirmed.
    """

    numerator: int = 80
    denominator: int = 100
    width: int = 5
    bands: int = 32
    rows: int = 5
    bits: int = 4
    slack: float = 5.0

    @property
    def hashes(self) -> int:
        return self.bands * self.rows

    @property
    def least_lanes(self) -> int:
        """Equal lanes below which a pair is no candidate any more."""
        chance = 2.0**-self.bits
        s = self.numerator / self.denominator
        equal = s + (1 - s) * chance
        error = (equal * (1 - equal) / self.hashes) ** 0.5
        return int(np.floor(self.hashes * (equal - self.slack * error)))


SIGNED = "n_shingles long, node binary, bands array<long>, signature array<long>"
BLOCK = 512  # members of a bucket that one task compares with as many others
BLOCK_SHINGLES = 1 << 21  # shingles of such a block
RUN = ("band", "left", "right")  # a block of a bucket and another one, or itself


def near_duplicates(
    docs: DataFrame, rule: NearDuplicates = NearDuplicates(), folder: str | None = None
) -> DataFrame:
    """(doc_id, text_key, n_shingles, component, component_id, kept) for every row of ``docs``.

    ``component_id`` is the smallest doc_id that links lead to, the document's own
    included; ``kept`` says that it is its own. A text without words (null, empty,
    white space) has no shingles, links with nothing and is kept. Repeated rows
    and texts of equal shingles are one class, which stands for them in bands and
    links; a class of nulls among doc_ids takes its smallest other doc_id, and
    where a component has none, its component_id is null and its rows are kept.
    ``text_key`` is the MD5 of the text and ``component`` a digest that names the
    component, null without shingles. Other columns of ``docs`` are ignored.

    Buckets of a band are never paired off. Each member is confirmed against the
    bucket's least member; only where that leaves a bucket in several components
    are members of different ones compared, block by block, and pairs whose
    distances to the least member differ by more than the allowed distance are
    passed over, since Jaccard distance is a metric. A block yields the links that
    join its components, so its output grows with its members, not their pairs.
    """
    spark = docs.sparkSession
    folder = folder or scratch_dir(spark)
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    signed = write_layer(_sign(texts, rule), layer_path(folder, "minhash", "signed")).frame
    classes = write_layer(_classes(signed), layer_path(folder, "minhash", "classes")).frame
    shared = write_layer(_shared_buckets(classes), layer_path(folder, "minhash", "shared")).frame
    stars = write_layer(_stars(shared, classes, rule), layer_path(folder, "minhash", "stars")).frame
    checked = _confirm(texts, classes, stars, rule)
    checked = write_layer(checked, layer_path(folder, "minhash", "checked")).frame
    links = checked.where("linked").select("a", "b")
    joined = connected_components(links, f"{folder}/first")
    open_rows = write_layer(
        _open_members(shared, classes, joined, checked, rule), layer_path(folder, "minhash", "open")
    )
    if open_rows.rows:
        more = _joining_links(texts, classes, open_rows.frame, rule)
        more = write_layer(links.union(more), layer_path(folder, "minhash", "links"))
        joined = connected_components(more.frame, f"{folder}/second")
    return _labelled(signed, classes, joined)


def _sign(texts: DataFrame, rule: NearDuplicates) -> DataFrame:
    """Class, bands and packed signature of each text."""
    keyed = texts.withColumn("text_key", F.unhex(F.md5(F.coalesce("text", F.lit("")))))
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("text_key", pa.binary()),
            ("n_shingles", pa.int64()),
            ("node", pa.binary()),
            ("bands", pa.list_(pa.int64())),
            ("signature", pa.list_(pa.int64())),
        ]
    )

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(rule)
        for batch in batches:
            counts, nodes, bands, signatures = [], [], [], []
            for text in utf8(batch.column("text")):
                shingles = shingle_set(word_hashes(text), rule.width)
                counts.append(len(shingles))
                if len(shingles):
                    nodes.append(xxhash.xxh3_128_digest(shingles.tobytes()))
                    band, signature = signer(shingles)
                else:
                    nodes.append(None)
                    band = signature = None
                bands.append(band)
                signatures.append(signature)
            columns = [batch.column("doc_id"), batch.column("text_key"), counts, nodes, bands, signatures]
            yield pa.RecordBatch.from_arrays(
                [
                    c if isinstance(c, pa.Array) else pa.array(c, field.type)
                    for c, field in zip(columns, schema)
                ],
                schema=schema,
            )

    return keyed.mapInArrow(sign, f"doc_id long, text_key binary, {SIGNED}")


class Signer:
    """Minima of a shingle set, as band hashes and as packed low bits."""

    def __init__(self, rule: NearDuplicates):
        self.rule = rule
        seeds = mix(np.arange(1, 2 * rule.hashes + 1, dtype=np.uint64))
        self.factors = (seeds[: rule.hashes] | np.uint64(1)).astype(np.uint32)[:, None]
        self.offsets = (seeds[rule.hashes :] >> np.uint64(32)).astype(np.uint32)[:, None]
        self.salts = mix(np.arange(rule.bands, dtype=np.uint64) + np.uint64(7919))

    def minima(self, shingles: np.ndarray) -> np.ndarray:
        """Least value of each hash function, in steps that stay in the cache."""
        values = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
        least = np.full(self.rule.hashes, 0xFFFFFFFF, dtype=np.uint32)
        for start in range(0, len(values), 2048):
            step = values[None, start : start + 2048] * self.factors
            step ^= step >> np.uint32(15)
            step *= np.uint32(0x2C1B3C6D)
            step += self.offsets
            step ^= step >> np.uint32(13)
            np.minimum(least, step.min(axis=1), out=least)
        return least

    def __call__(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rule = self.rule
        least = self.minima(shingles)
        runs = least.reshape(rule.bands, rule.rows).astype(np.uint64)
        bands = self.salts.copy()
        for k in range(rule.rows):
            bands = mix(bands ^ runs[:, k])
        low = least & np.uint32(2**rule.bits - 1)
        return bands.view(np.int64), pack_lanes(low, rule.bits).view(np.int64)


def pack_lanes(values: np.ndarray, bits: int) -> np.ndarray:
    """Values of ``bits`` bits side by side in 64-bit words; missing lanes are zero."""
    per_word = 64 // bits
    padded = np.zeros(-(-len(values) // per_word) * per_word, dtype=np.uint64)
    padded[: len(values)] = values
    shifts = np.arange(per_word, dtype=np.uint64) * np.uint64(bits)
    return np.bitwise_or.reduce(padded.reshape(-1, per_word) << shifts, axis=1)


def unequal_lanes(difference: np.ndarray, bits: int) -> np.ndarray:
    """Lanes that differ, counted in the XOR of packed words."""
    folded, width = difference, 1
    while width < bits:
        folded = folded | (folded >> np.uint64(width))
        width *= 2
    lanes = np.uint64(sum(1 << (bits * k) for k in range(64 // bits)))
    return np.bitwise_count(folded & lanes)


def estimated_similarity(equal_lanes: Column | float, rule: NearDuplicates):
    """Similarity from the number of equal lanes, with agreement by chance taken out."""
    chance = 2.0**-rule.bits
    return (equal_lanes / rule.hashes - chance) / (1 - chance)


def _equal_lanes(rule: NearDuplicates) -> Column:
    """Equal lanes of the columns sign_a and sign_b, counted in the JVM."""
    mask = sum(1 << (rule.bits * k) for k in range(64 // rule.bits))
    mask -= 1 << 64 if mask >= 1 << 63 else 0

    def unequal(x: Column, y: Column) -> Column:
        folded, width = x.bitwiseXOR(y), 1
        while width < rule.bits:
            folded = folded.bitwiseOR(F.shiftrightunsigned(folded, width))
            width *= 2
        return F.bit_count(folded.bitwiseAND(F.lit(mask)))

    differing = F.aggregate(F.zip_with("sign_a", "sign_b", unequal), F.lit(0), lambda t, x: t + x)
    return F.lit(rule.hashes) - differing


def _classes(signed: DataFrame) -> DataFrame:
    """One row per shingle set: its smallest doc_id and one of its texts."""
    return (
        signed.where("node is not null")
        .groupBy("node")
        .agg(
            F.min("doc_id").alias("first_id"),
            F.min("text_key").alias("text_key"),
            F.first("bands").alias("bands"),
            F.first("signature").alias("signature"),
            F.first("n_shingles").alias("n_shingles"),
        )
    )


def _shared_buckets(classes: DataFrame) -> DataFrame:
    """(band, node, pivot, n) for buckets of several members; the pivot is the least one."""
    bucketed = classes.select("node", F.explode("bands").alias("band"))
    pivots = bucketed.groupBy("band").agg(F.min("node").alias("pivot"), F.count("*").alias("n"))
    return bucketed.join(pivots.where("n > 1"), "band")


def _stars(shared: DataFrame, classes: DataFrame, rule: NearDuplicates) -> DataFrame:
    """Distinct candidate pairs of each bucket's pivot (a) and another member (b)."""
    pairs = (
        shared.where("pivot != node")
        .select(F.col("pivot").alias("a"), F.col("node").alias("b"))
        .distinct()
    )
    signs = classes.select("node", "signature")
    return (
        pairs.join(signs.select(F.col("node").alias("a"), F.col("signature").alias("sign_a")), "a")
        .join(signs.select(F.col("node").alias("b"), F.col("signature").alias("sign_b")), "b")
        .where(_equal_lanes(rule) >= _least_for_distance(rule))
        .select("a", "b")
    )


def _least_for_distance(rule: NearDuplicates) -> int:
    """Equal lanes at twice the allowed distance: nearer pairs get an exact distance."""
    s = max(0.0, 1 - 2 * (1 - rule.numerator / rule.denominator))
    wide = NearDuplicates(
        round(1000 * s), 1000, rule.width, rule.bands, rule.rows, rule.bits, rule.slack
    )
    return wide.least_lanes


def _confirm(texts: DataFrame, classes: DataFrame, pairs: DataFrame, rule: NearDuplicates) -> DataFrame:
    """(a, b, common, total, linked) on full shingle sets.

    One text of each class in question is fetched by its key. Pairs meet their
    second text first and are then brought to the first, so that a hub's text is
    sent once and only its pairs are spread; the join splits a hub's pairs.
    """
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    fetched = _texts_of(texts, classes, wanted)
    both = pairs.join(
        fetched.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"
    ).join(fetched.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    numerator, denominator, width = rule.numerator, rule.denominator, rule.width
    schema = pa.schema(
        [
            ("a", pa.binary()),
            ("b", pa.binary()),
            ("common", pa.int64()),
            ("total", pa.int64()),
            ("linked", pa.bool_()),
        ]
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = first = None
        for batch in batches:
            common, total = [], []
            rows = zip(batch.column("a").to_pylist(), utf8(batch.column("text_a")), utf8(batch.column("text_b")))
            for a, text_a, text_b in rows:
                if a != last:
                    last, first = a, shingle_set(word_hashes(text_a), width)
                second = shingle_set(word_hashes(text_b), width)
                shared = len(np.intersect1d(first, second, assume_unique=True))
                common.append(shared)
                total.append(len(first) + len(second) - shared)
            linked = [denominator * c >= numerator * t for c, t in zip(common, total)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(batch.column("a").to_pylist(), pa.binary()),
                    pa.array(batch.column("b").to_pylist(), pa.binary()),
                    pa.array(common, pa.int64()),
                    pa.array(total, pa.int64()),
                    pa.array(linked, pa.bool_()),
                ],
                schema=schema,
            )

    return both.select("a", "b", "text_a", "text_b").mapInArrow(
        compare, "a binary, b binary, common long, total long, linked boolean"
    )


def _texts_of(texts: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, text): one text of each wanted class, fetched by its key and stored."""
    keys = classes.join(wanted, "node").select("node", "text_key")
    found = (
        texts.select(F.unhex(F.md5("text")).alias("text_key"), "text")
        .join(keys, "text_key")
        .groupBy("node")
        .agg(F.first("text").alias("text"))
    )
    folder = scratch_dir(texts.sparkSession)
    return write_layer(found, layer_path(folder, "minhash", "texts")).frame


def _open_members(
    shared: DataFrame, classes: DataFrame, joined: DataFrame, checked: DataFrame, rule: NearDuplicates
) -> DataFrame:
    """Members with a candidate in another component of their bucket, by run of blocks.

    Only buckets of three and more members with several components matter.
    Members linked to the pivot are one component, so they meet the others only.
    A distance to the pivot that was not confirmed exceeds twice the allowed one.
    """
    labels = joined.withColumnRenamed("component", "label")
    members = (
        shared.where("n > 2")
        .drop("n")
        .join(labels, "node", "left")
        .withColumn("label", F.coalesce("label", "node"))
        .join(classes.select("node", "n_shingles"), "node")
    )
    size = F.greatest(F.count("*") / BLOCK, F.sum("n_shingles") / BLOCK_SHINGLES)
    mixed = (
        members.groupBy("band")
        .agg(
            F.min("label").alias("low"),
            F.max("label").alias("high"),
            F.ceil(size).cast("int").alias("blocks"),
        )
        .where("low != high")
        .select("band", "blocks")
    )
    distance = checked.select(
        F.col("a").alias("pivot"),
        F.col("b").alias("node"),
        (1 - F.col("common") / F.col("total")).alias("gap"),
        "linked",
    )
    is_pivot = F.col("pivot") == F.col("node")
    near = is_pivot | F.coalesce("linked", F.lit(False))
    blocks = F.col("blocks")
    part = F.pmod(F.xxhash64("node"), blocks).cast("int")
    others = F.sequence(F.lit(0), 2 * blocks - 1)
    sent = (
        members.join(mixed, "band")
        .join(distance, ["pivot", "node"], "left")
        .select(
            "band",
            "node",
            "label",
            F.when(is_pivot, 0.0).otherwise(F.coalesce("gap", F.lit(2.0))).alias("gap"),
            F.when(near, part).otherwise(blocks + part).alias("block"),
            F.when(near, F.slice(others, blocks + 1, blocks)).otherwise(others).alias("others"),
        )
        .withColumn("other", F.explode("others"))
        .withColumn("left", F.least("block", "other"))
        .withColumn("right", F.greatest("block", "other"))
        .join(classes.select("node", "signature", "bands"), "node")
    )
    return _by_run(sent, OpenRows(rule), OPEN)


def _joining_links(
    texts: DataFrame, classes: DataFrame, open_rows: DataFrame, rule: NearDuplicates
) -> DataFrame:
    """(a, b): confirmed links that join components within runs of blocks."""
    fetched = _texts_of(texts, classes, open_rows.select("node").distinct())
    return _by_run(open_rows.join(fetched, "node"), JoiningLinks(rule), "a binary, b binary")


OPEN = (
    "band long, left int, right int, block int, node binary, label binary, gap double, "
    "signature array<long>, bands array<long>"
)


def _by_run(rows: DataFrame, task: BlockComparison, schema: str) -> DataFrame:
    """Apply a task to rows that come together by run."""
    columns = [part.split()[0] for part in OPEN.split(", ")]
    columns += ["text"] if "text" in rows.columns else []
    ordered = rows.repartition(*RUN).sortWithinPartitions(*RUN)
    return ordered.select(*columns).mapInArrow(task, schema)


class BlockComparison:
    """Candidates within runs of rows that share band, left and right block.

    A pair counts in the first band that it shares, so in one run only.
    """

    def __init__(self, rule: NearDuplicates):
        self.rule = rule
        self.allowed = 1 - rule.numerator / rule.denominator + 1e-9

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # rows of a run that may go on in the next batch
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held is not None else table
            keys = [table.column(name).to_numpy() for name in RUN]
            starts = np.flatnonzero(np.logical_or.reduce([np.diff(k) != 0 for k in keys])) + 1
            cut = int(starts[-1]) if len(starts) else 0
            held = table.slice(cut)
            if cut:
                yield from self.compare(table.slice(0, cut), [0, *starts.tolist()])
        if held is not None and len(held):
            yield from self.compare(held, [0, len(held)])

    def compare(self, table: pa.Table, bounds: list[int]) -> Iterator[pa.RecordBatch]:
        raise NotImplementedError

    def candidates(self, table: pa.Table, bounds: list[int]) -> Iterator[np.ndarray]:
        """For each run, (unequal lanes, row, row) of pairs of different components, least first."""
        n = len(table)
        label = np.array(table.column("label").to_pylist(), dtype="S16")
        label = np.unique(label, return_inverse=True)[1]
        gap, block = table.column("gap").to_numpy(), table.column("block").to_numpy()
        band, left, right = (table.column(name).to_numpy() for name in RUN)
        sign, bands = (
            table.column(name).combine_chunks().flatten().to_numpy().reshape(n, -1)
            for name in ("signature", "bands")
        )
        sign = sign.view(np.uint64)
        most = self.rule.hashes - self.rule.least_lanes
        for start, end in zip(bounds, bounds[1:]):
            rows = start + np.flatnonzero(block[start:end] == left[start])
            cols = start + np.flatnonzero(block[start:end] == right[start])
            found = [np.zeros((0, 3), dtype=np.int32)]
            for i in rows:
                against = cols[cols > i] if left[start] == right[start] else cols
                against = against[label[against] != label[i]]
                against = against[self._in_reach(gap[i], gap[against])]
                if len(against):
                    first = (bands[against] == bands[i]).argmax(axis=1)
                    against = against[bands[i][first] == band[start]]
                    unequal = unequal_lanes(sign[against] ^ sign[i], self.rule.bits).sum(axis=1)
                    alike = unequal <= most
                    pairs = np.empty((int(alike.sum()), 3), dtype=np.int32)
                    pairs[:, 0], pairs[:, 1], pairs[:, 2] = unequal[alike], i, against[alike]
                    found.append(pairs)
            pairs = np.concatenate(found)
            yield pairs[np.argsort(pairs[:, 0], kind="stable")]

    def _in_reach(self, gap: float, others: np.ndarray) -> np.ndarray:
        """Whether distances to the pivot allow a link; those over 1 are not known."""
        known = np.abs(others - gap) <= self.allowed if gap <= 1 else others > self.allowed
        return known | ((others > 1) & (gap > self.allowed))


class OpenRows(BlockComparison):
    """Rows of runs that are in a candidate pair."""

    def compare(self, table: pa.Table, bounds: list[int]) -> Iterator[pa.RecordBatch]:
        needed = np.zeros(len(table), dtype=bool)
        for found in self.candidates(table, bounds):
            needed[found[:, 1:]] = True
        yield from table.filter(pa.array(needed)).to_batches()


class JoiningLinks(BlockComparison):
    """Links of a run, likeliest first, passing over pairs that earlier ones joined."""

    def compare(self, table: pa.Table, bounds: list[int]) -> Iterator[pa.RecordBatch]:
        rule = self.rule
        node, label = table.column("node").to_pylist(), table.column("label").to_pylist()
        texts = table.column("text")
        links = []
        for found in self.candidates(table, bounds):
            sets: dict[int, np.ndarray] = {}
            over: dict[bytes, bytes] = {}

            def root(at: bytes) -> bytes:
                while at in over:
                    at = over[at]
                return at

            for pair in found:
                i, j = int(pair[1]), int(pair[2])
                a, b = root(label[i]), root(label[j])
                if a == b:
                    continue
                for k in (i, j):
                    if k not in sets:
                        sets[k] = shingle_set(word_hashes(texts[k].as_py().encode()), rule.width)
                common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                total = len(sets[i]) + len(sets[j]) - common
                if rule.denominator * common >= rule.numerator * total:
                    over[a] = b
                    links.append((node[i], node[j]))
        columns = [pa.array([pair[k] for pair in links], pa.binary()) for k in (0, 1)]
        yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])


def _labelled(signed: DataFrame, classes: DataFrame, joined: DataFrame) -> DataFrame:
    """Component and verdict of every row."""
    labelled = classes.select("node", "first_id").join(joined, "node", "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "node"))
    smallest = labelled.groupBy("component").agg(F.min("first_id").alias("component_id"))
    labels = labelled.select("node", "component").join(smallest, "component")
    found = signed.select("doc_id", "text_key", "n_shingles", "node").join(labels, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select(
        "doc_id",
        "text_key",
        "n_shingles",
        "component",
        component.alias("component_id"),
        component.eqNullSafe(F.col("doc_id")).alias("kept"),
    )


def without_near_duplicates(
    docs: DataFrame, rule: NearDuplicates = NearDuplicates(), folder: str | None = None
) -> DataFrame:
    """One document of each component, and every document without words, with all columns.

    The one is the kept document; where several rows share its doc_id, the one of
    least text key, and of equal rows any one.
    """
    own_id, own_key, row = unused(docs, "_id", "_key", "_row")
    found = near_duplicates(docs, rule, folder)
    chosen = (
        found.where("kept and component is not null")
        .groupBy("component")
        .agg(F.min(F.struct("doc_id", "text_key")).alias("_chosen"))
        .select(F.col("_chosen.doc_id").alias(own_id), F.col("_chosen.text_key").alias(own_key))
    )
    words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(own_id)) & (F.unhex(F.md5("text")) == F.col(own_key))
    own = Window.partitionBy(own_id, own_key).orderBy(own_key)
    first = (
        docs.where(words)
        .join(chosen, same)
        .withColumn(row, F.row_number().over(own))
        .where(F.col(row) == 1)
    )
    return first.select(*docs.columns).union(docs.where(~words))
