"""SentencePiece encoding and decoding over a relational lattice.

Texts are cut into units that no piece of the model crosses. The distinct units of the corpus are exploded into
substrings of bounded length and equi-joined to the piece table; the edges of each unit are gathered and folded into its
ids. A unigram model's fold is Viterbi's best path, with Spark's higher-order functions; a BPE model's fold joins the
neighbours whose piece comes first, leftmost first, as that kind of model defines its ids, one join in every unit of an
Arrow batch at a time. Characters without a piece become byte pieces.

Texts then look their units up. The ``FREQUENT`` most frequent units of ``SAMPLE`` documents (stated bounds) are folded
first and broadcast; this decides only which way a unit goes. All other units of every text are gathered with the slices of
texts that hold them, folded once each and joined back to those slices. Units of over ``LONG`` characters, whose lattice
has no bound, are folded by a heap over the same pieces in the task.

Null and empty texts have no ids and decode to the empty text. The character U+2581 decodes to a blank, as the
model has it. Repeated rows are encoded alike.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import bound_batches, bounded_sample
from millrace.llm.words import as_bytes, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
FREQUENT, SAMPLE, LONG = 200_000, 10_000, 512
#: Bytes of text that are cut at a time; one longer text is a slice of its own.
SLICE = 1 << 20
BLANK = "▁"
#: Score of a character without a piece on a Viterbi path, below the least score.
UNKNOWN_STEP = 10.0
_WIDE = 1 << 20
#: Rank of no piece.
NONE = np.iinfo(np.int32).max


@dataclass
class Units:
    """Unit occurrences of some texts: ``known[code[i]]``; those of text t are from ``ends[t]`` to ``ends[t + 1]``."""

    known: pa.Array
    code: np.ndarray
    ends: np.ndarray


@dataclass(frozen=True)
class Model:
    """A piece table: (piece, id, score) of ordinary pieces, the id of byte 0, and what follows from them."""

    rows: list[tuple[str, int, float]]
    byte_zero: int
    unigram: bool
    prefix: bool = True
    texts: list[bytes] = field(default_factory=list)  # by id, for decoding

    @cached_property
    def longest(self) -> int:
        return max(len(p) for p, _, _ in self.rows)

    @cached_property
    def ids(self) -> dict[str, tuple[int, float]]:
        return {p: (i, s) for p, i, s in self.rows}

    @cached_property
    def _neighbours(self) -> tuple[np.ndarray, np.ndarray]:
        """The number of each character that some longer piece holds (others: 0), and which two may be neighbours in a unit."""
        pairs = {p[i : i + 2] for p, _, _ in self.rows for i in range(len(p) - 1)}
        letters = sorted({c for pair in pairs for c in pair})
        numbers = np.zeros(0x110000, np.uint16)
        numbers[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        held = np.zeros((len(letters) + 1, len(letters) + 1), bool)
        for a, b in pairs:
            held[numbers[ord(a)], numbers[ord(b)]] = True
        return numbers, held

    @cached_property
    def order(self) -> np.ndarray:
        """Rank of each id's piece, the best score first, equal scores alike; at the end that of no piece."""
        _, ranks = np.unique([-s for _, _, s in self.rows], return_inverse=True)
        order = np.full(max((i for _, i, _ in self.rows), default=0) + 2, NONE, np.int32)
        order[[i for _, i, _ in self.rows]] = ranks
        return order

    @cached_property
    def letters(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes of all ids' texts in a row, where each id's begin, and how many they are."""
        sizes = np.array([len(t) for t in self.texts], np.int64)
        return np.frombuffer(b"".join(self.texts), np.uint8), np.cumsum(sizes) - sizes, sizes

    def cut(self, texts: pa.Array) -> Units:
        """The units of texts in order; joined, they are the text with its blanks replaced.

        A unit ends wherever no piece holds the two characters side by side, so no piece crosses its ends.
        """
        marked = pc.replace_substring(pc.fill_null(texts, "").cast(pa.large_string()), " ", BLANK)
        if self.prefix:
            begun = pc.binary_join_element_wise(pa.scalar(BLANK, pa.large_string()), marked, pa.scalar("", pa.large_string()))
            marked = pc.if_else(pc.equal(marked, ""), marked, begun)
        data, ends = as_bytes(marked)
        numbers, held = self._neighbours
        kinds = numbers[np.frombuffer(str(data, "utf-8").encode("utf-32-le"), np.uint32)]
        heads = np.flatnonzero((data & 0xC0) != 0x80)
        begins = np.ones(len(kinds), bool)
        begins[1:] = ~held[kinds[:-1], kinds[1:]]
        bounds = np.searchsorted(heads, ends)
        begins[bounds[:-1][bounds[:-1] < len(kinds)]] = True  # a unit does not go on into the next text
        places = np.flatnonzero(begins)
        offsets = np.append(heads[places], len(data)).astype(np.int64)
        coded = pa.LargeStringArray.from_buffers(len(places), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))).dictionary_encode()
        return Units(coded.dictionary, coded.indices.to_numpy(), np.searchsorted(places, bounds))

    def spelled(self, piece: str) -> list[int]:
        """The id of a piece, or its bytes."""
        known = self.ids.get(piece)
        return [known[0]] if known else [self.byte_zero + b for b in piece.encode("utf-8", "surrogatepass")]


def read_model(path: str = MODEL) -> Model:
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        proto.ParseFromString(file.read())
    kinds = sentencepiece_model_pb2.ModelProto.SentencePiece.Type
    rows, texts, zero = [], [], -1
    for number, p in enumerate(proto.pieces):
        if p.type == kinds.BYTE:
            byte = int(p.piece[3:5], 16)
            zero = number - byte if zero < 0 else zero
            if number - byte != zero:
                raise ValueError("byte pieces are not in a row")
            texts.append(bytes([byte]))
        elif p.type in (kinds.NORMAL, kinds.USER_DEFINED):
            rows.append((p.piece, number, p.score))
            texts.append(p.piece.replace(BLANK, " ").encode())
        else:
            texts.append(b"")
    spec = proto.normalizer_spec
    if zero < 0 or spec.precompiled_charsmap or spec.remove_extra_whitespaces or proto.trainer_spec.model_type not in (1, 2):
        raise ValueError("only identity normalisation with byte fallback is read")
    return Model(rows, zero, proto.trainer_spec.model_type == 1, spec.add_dummy_prefix, texts)


def vocabulary(docs: DataFrame, model: Model) -> DataFrame:
    """(unit, n): the distinct units of all texts, pre-counted by slices. Partitioned by unit."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, SLICE):
            units = shared.value.cut(part["text"])
            counts = np.bincount(units.code, minlength=len(units.known))
            yield pa.RecordBatch.from_arrays([units.known.cast(pa.string()), pa.array(counts, pa.int64())], names=["unit", "n"])

    texts = docs.select(F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n"))


def lattice(units: DataFrame, model: Model) -> DataFrame:
    """``units`` with ``edges``: every substring that is a piece, as (start, end, id, score); units without one have none.

    A BPE model needs substrings of two characters and more, and no scores: (start, end, id) in one number. ``units`` are
    distinct, come partitioned by unit and stay so: edges meet their unit without a shuffle. Units of over ``LONG`` characters
    get no edges.
    """
    spark = units.sparkSession
    table = F.broadcast(spark.createDataFrame(model.rows, "piece string, id int, score double"))  # the model's own table
    least = 1 if model.unigram else 2
    length = F.length("unit")
    begins = F.when((length >= least) & (length <= LONG), F.sequence(F.lit(0), length - least)).otherwise(F.array().cast("array<int>"))
    starts = units.select(*units.columns, F.explode_outer(begins).alias("start"))
    sizes = F.sequence(F.lit(least), F.least(F.lit(max(model.longest, least)), length - F.col("start")))
    parts = starts.select("*", F.explode_outer(sizes).alias("size")).withColumn("end", F.col("start") + F.col("size"))
    parts = parts.withColumn("piece", F.substring("unit", F.col("start") + 1, F.col("size")))
    one = F.struct("start", "end", "id", "score") if model.unigram else (F.col("start").cast("long") * _WIDE + F.col("end")) * _WIDE + F.col("id")
    kept = F.col("id").isNotNull() | F.col("start").isNull() | (F.col("end") == F.lit(least))  # one row of each unit at least
    matched = parts.join(table, "piece", "left").where(kept)
    edges = F.collect_list(F.when(F.col("id").isNotNull(), one)).alias("edges")
    return matched.groupBy("unit").agg(*(F.first(c).alias(c) for c in units.columns if c != "unit"), edges)


def _spelled(segment: Column, byte_zero: int) -> Column:
    """Byte ids of a character without a piece."""
    code = F.hex(F.encode(segment, "UTF-8"))
    places = F.sequence(F.lit(1), F.length(code) - 1, F.lit(2))
    return F.transform(places, lambda i: F.conv(F.substring(code, i, F.lit(2)), 16, 10).cast("int") + byte_zero)


def _ids(cuts: Column, known: Column, model: Model) -> Column:
    """Ids of the segments between neighbouring cuts."""
    n = F.size(cuts) - 1

    def one(i: Column) -> Column:
        a, b = F.get(cuts, i), F.get(cuts, i + 1)
        edge = F.try_element_at(known, a * _WIDE + b)
        return F.when(edge.isNull(), _spelled(F.substring(F.col("unit"), a + 1, b - a), model.byte_zero)).otherwise(F.array(edge["id"]))

    return F.flatten(F.transform(F.sequence(F.lit(0), n - 1), one))


def viterbi_cuts(least: float) -> Column:
    """Unigram: boundaries of the path with the largest sum of scores, folded over end positions."""
    size = F.length("unit")
    kind = "struct<best: array<double>, back: array<int>>"

    def step(acc: Column, end: Column) -> Column:
        here = F.filter("edges", lambda x: x["end"] == end)
        paths = F.transform(here, lambda x: F.struct((F.get(acc["best"], x["start"]) + x["score"]).alias("s"), x["start"].alias("a")))
        lone = F.struct((F.get(acc["best"], end - 1) + F.lit(least - UNKNOWN_STEP)).alias("s"), (end - 1).alias("a"))
        paths = F.when(F.exists(here, lambda x: x["start"] == end - 1), paths).otherwise(F.array_append(paths, lone))
        best = F.array_max(paths)
        return F.struct(F.array_append(acc["best"], best["s"]).alias("best"), F.array_append(acc["back"], best["a"]).alias("back")).cast(kind)

    start = F.struct(F.array(F.lit(0.0)).alias("best"), F.array(F.lit(0)).alias("back")).cast(kind)
    back = F.aggregate(F.sequence(F.lit(1), size), start, step)["back"]
    follow = lambda cuts, _: F.when(F.get(cuts, F.lit(0)) > 0, F.array_prepend(cuts, F.get(back, F.get(cuts, F.lit(0))))).otherwise(cuts)
    return F.aggregate(F.sequence(F.lit(1), size), F.array(size), follow)


def _run(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of runs that begin at ``starts``, one run after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


def joined(units: pa.Array, edges: pa.ListArray, model: Model) -> pa.ListArray:
    """BPE: ids after joining, step by step, the neighbours with the best piece, leftmost first; in all units at once."""
    data, _ = as_bytes(units)
    chars = np.frombuffer(str(data, "utf-8").encode("utf-32-le"), np.uint32)
    lengths = pc.utf8_length(units).to_numpy().astype(np.int64)
    first = np.concatenate(([0], np.cumsum(lengths)))
    wide = model.longest + 1
    found = edges.flatten().to_numpy()
    of = np.repeat(first[:-1], pc.list_value_length(edges).to_numpy())
    start, end = found >> 40, (found >> 20) & (_WIDE - 1)
    piece = np.full(len(chars) * wide + 1, -1, np.int32)  # by place and size
    piece[(of + start) * wide + end - start] = found & (_WIDE - 1)

    def rank(i: np.ndarray) -> np.ndarray:
        """Of symbols i joined with the next ones."""
        after = np.minimum(i + 1, len(at) - 1)
        both = size[i] + size[after]
        fits = (after > i) & (unit[i] == unit[after]) & (both < wide)
        return model.order[piece[np.where(fits, at[i] * wide + both, -1)]]

    at, size, unit = np.arange(len(chars)), np.ones(len(chars), np.int64), np.repeat(np.arange(len(lengths)), lengths)
    ranks, ended = rank(at), []
    while len(at):
        heads = np.flatnonzero(np.diff(unit, prepend=-1))
        best = np.minimum.reduceat(ranks, heads)
        best = np.repeat(best, np.diff(heads, append=len(at)))
        going = best < NONE
        if not going.all():
            ended.append((at[~going], size[~going]))
            at, size, unit, ranks, best = at[going], size[going], unit[going], ranks[going], best[going]
        hits = np.flatnonzero(ranks == best)
        hits = hits[np.diff(unit[hits], prepend=-1) != 0]
        size[hits] += size[hits + 1]
        stay = np.ones(len(at), bool)
        stay[hits + 1] = False
        at, size, unit, ranks = at[stay], size[stay], unit[stay], ranks[stay]
        hits -= np.arange(len(hits))
        changed = np.concatenate((hits, hits[hits > 0] - 1))
        ranks[changed] = rank(changed)
    at, size = (np.concatenate([e[k] for e in ended] or [np.empty(0, np.int64)]) for k in (0, 1))
    order = np.argsort(at)
    at, size = at[order], size[order]

    alone, number = np.unique(chars[at[size == 1]], return_inverse=True)
    spelled = [model.spelled(chr(c)) for c in alone]
    each = np.array([len(s) for s in spelled], np.int64)
    source = np.concatenate((piece[at * wide + size], np.array([i for s in spelled for i in s], np.int32)))
    starts, sizes = np.arange(len(at)), np.ones(len(at), np.int64)
    starts[size == 1] = len(at) + (np.cumsum(each) - each)[number]
    sizes[size == 1] = each[number]
    offsets = np.concatenate(([0], np.cumsum(sizes)))[np.searchsorted(at, first)]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(source[_run(starts, sizes)], pa.int32()))


def encoded_units(units: DataFrame, model: Model) -> DataFrame:
    """The distinct ``units`` with their ids instead of edges."""
    edges = lattice(units, model)
    if model.unigram:
        pairs = F.transform("edges", lambda x: F.struct((x["start"] * _WIDE + x["end"]).alias("key"), F.struct(x["id"].alias("id"), x["score"].alias("score")).alias("value")))
        cuts = viterbi_cuts(min(s for _, _, s in model.rows))
        short = edges.withColumn("known", F.map_from_entries(pairs)).withColumn("cuts", F.when(F.length("unit") <= LONG, cuts))
        edges = short.select(*units.columns, F.when(F.col("cuts").isNotNull(), _ids(F.col("cuts"), F.col("known"), model)).alias("ids"))
    shared = units.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            folded = batch.column(batch.num_columns - 1)
            folded = folded if shared.value.unigram else _joined_or_long(batch["unit"], folded, shared.value)
            if folded.null_count:
                whole = [long_ids(u, shared.value) if i is None else i for u, i in zip(batch["unit"].to_pylist(), folded.to_pylist())]
                folded = pa.array(whole, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], folded], names=[*batch.schema.names[:-1], "ids"])

    return edges.mapInArrow(run, units.withColumn("ids", F.array().cast("array<int>")).schema)


def _joined_or_long(units: pa.Array, edges: pa.ListArray, model: Model) -> pa.ListArray:
    """Ids of the units that have a lattice; null for those of over ``LONG`` characters."""
    short = pc.less_equal(pc.utf8_length(units), LONG)
    if pc.all(short).as_py() is not False:
        return joined(units, edges, model)
    place = pc.if_else(short, pa.array(np.cumsum(short.to_numpy(zero_copy_only=False)) - 1), None)
    return joined(units.filter(short), edges.filter(short), model).take(place)


def long_ids(unit: str, model: Model) -> list[int]:
    """Ids of one unit: the same folds, for a BPE model with a heap of joinable neighbours, in n log n."""
    if model.unigram:
        least = min(s for _, _, s in model.rows) - UNKNOWN_STEP
        best, back = [0.0], [0]
        for end in range(1, len(unit) + 1):
            paths = [(best[a] + model.ids[unit[a:end]][1], a) for a in range(max(0, end - model.longest), end) if unit[a:end] in model.ids]
            if unit[end - 1] not in model.ids:
                paths.append((best[end - 1] + least, end - 1))
            score, a = max(paths)
            best.append(score)
            back.append(a)
        segments, end = [], len(unit)
        while end:
            segments.append(unit[back[end] : end])
            end = back[end]
        return [i for s in reversed(segments) for i in model.spelled(s)]
    ends, before = {i: i + 1 for i in range(len(unit))}, {i: i - 1 for i in range(1, len(unit))}
    heap: list[tuple[float, int, int, int]] = []

    def offer(a: int) -> None:
        b = ends[a]
        if b in ends and (known := model.ids.get(unit[a : ends[b]])):
            heapq.heappush(heap, (-known[1], a, b, ends[b]))

    for a in range(len(unit)):
        offer(a)
    while heap:
        _, a, b, c = heapq.heappop(heap)
        if ends.get(a) == b and ends.get(b) == c:
            ends[a] = c
            del ends[b]
            if c in ends:
                before[c] = a
            offer(a)
            if a in before:
                offer(before[a])
    return [i for a in sorted(ends) for i in model.spelled(unit[a : ends[a]])]


@dataclass
class Table:
    """Units and their ids: those of ``units[k]`` are ``sizes[k]`` from ``starts[k]`` on."""

    units: pa.Array
    ids: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, units: pa.Array, ids: pa.ListArray) -> Table:
        offsets = ids.offsets.to_numpy().astype(np.int64)
        return cls(units.cast(pa.large_string()), ids.values.to_numpy(zero_copy_only=False), offsets[:-1], np.diff(offsets))


def _looked_up(units: Units, tables: list[Table], model: Model) -> pa.ListArray:
    """Ids of the texts, from the first table that holds a unit; units that no table holds are folded here."""
    sources, base = [], 0
    starts, sizes = np.zeros(len(units.known), np.int64), np.full(len(units.known), -1, np.int64)
    for table in tables:
        lacking = np.flatnonzero(sizes < 0)
        at = pc.fill_null(pc.index_in(units.known.take(pa.array(lacking)), value_set=table.units), -1).to_numpy()
        lacking, at = lacking[at >= 0], at[at >= 0]
        starts[lacking], sizes[lacking] = table.starts[at] + base, table.sizes[at]
        sources.append(table.ids)
        base += len(table.ids)
    for k in np.flatnonzero(sizes < 0):
        sources.append(np.array(long_ids(units.known[k].as_py(), model), np.int32))
        starts[k], sizes[k] = base, len(sources[-1])
        base += len(sources[-1])
    sizes = sizes[units.code]
    source = np.concatenate([*sources, np.empty(0, np.int32)])
    offsets = np.concatenate(([0], np.cumsum(sizes)))[units.ends]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(source[_run(starts[units.code], sizes)], pa.int32()))


def _written(part: pa.RecordBatch) -> tuple[int, bytes]:
    """A slice of texts as Arrow stream, and its key, a hash of that."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, part.schema) as stream:
        stream.write_batch(part)
    whole = sink.getvalue().to_pybytes()
    return xxhash.xxh3_64_intdigest(whole) - (1 << 63), whole


#: What a worker makes of a slice: (doc_id and text, ids, model) to the columns it returns.
Finish = Callable[[pa.RecordBatch, pa.ListArray, Model], list[pa.Array]]


def _encoded(docs: DataFrame, model: Model, frequent: int, finish: Finish, kinds: str) -> DataFrame:
    """What ``finish`` makes of every row's whole text and its ids.

    Texts move once, in compressed slices, to where the ids of their other units are gathered. A slice's key is a hash of
    its content. Were slices cut differently from scan to scan, units without a partner would be folded in the task.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ids = bounded_sample(rows.select(F.col("doc_id").alias("__id")).where("__id IS NOT NULL").distinct(), SAMPLE, "__id")
    sample = rows.join(F.broadcast(ids), F.col("doc_id") == F.col("__id"))
    parts = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    often = vocabulary(sample, model).orderBy(F.desc("n"), "unit").limit(frequent).select("unit").repartition(parts, "unit")
    known = encoded_units(often, model).toArrow()
    shared = spark.sparkContext.broadcast((model, Table.of(*(known[c].combine_chunks() for c in ("unit", "ids")))))
    names = kinds.replace(",", "").split()[::2]

    def lacking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, table = shared.value
        for part in slices(batches, SLICE):
            units = held.cut(part["text"]).known
            units = units.filter(pc.invert(pc.is_in(units, value_set=table.units))).cast(pa.string())
            yield pa.RecordBatch.from_arrays([units, pa.array(np.full(len(units), _written(part)[0]), pa.int64())], names=["unit", "key"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, SLICE):
            key, whole = _written(part)
            row = [pa.array([key], pa.int64()), pa.array([len(whole)], pa.int64()), pa.array([pa.compress(whole, "zstd", asbytes=True)], pa.binary())]
            yield pa.RecordBatch.from_arrays(row, names=["key", "size", "texts"])

    def completed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, table = shared.value
        for batch in batches:
            for size, texts, more in zip(batch["size"].to_pylist(), batch["texts"], batch["more"]):
                own = [Table.of(more.values.field("unit"), more.values.field("ids"))] if more.is_valid else []
                part = pa.ipc.open_stream(pa.decompress(texts.as_buffer(), size, "zstd")).read_next_batch()
                found = _looked_up(held.cut(part["text"]), [table, *own], held)
                yield pa.RecordBatch.from_arrays(finish(part, found, held), names=names)

    others = rows.mapInArrow(lacking, "unit string, key long").repartition(parts, "unit")
    others = others.groupBy("unit").agg(F.collect_list("key").alias("keys"))
    narrow = "array<smallint>" if max(len(model.order), model.byte_zero + 256) < 1 << 15 else "array<int>"
    folded = encoded_units(others, model).select(F.explode("keys").alias("key"), "unit", F.col("ids").cast(narrow).alias("ids"))
    more = folded.repartition(parts, "key").groupBy("key").agg(F.collect_list(F.struct("unit", "ids")).alias("more"))
    held = rows.mapInArrow(packed, "key long, size long, texts binary").repartition(parts, "key")
    return held.hint("merge").join(more, "key", "left").select("size", "texts", "more").mapInArrow(completed, kinds)


def encoded(docs: DataFrame, model: Model, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, text, ids of every row's whole text."""
    finish = lambda part, ids, _: [part["doc_id"], part["text"], ids]
    return _encoded(docs, model, frequent, finish, "doc_id long, text string, ids array<int>")


def _texts(ids: pa.ListArray, model: Model) -> list[str]:
    """The texts of ids; null has none."""
    letters, starts, sizes = model.letters
    codes = ids.flatten().to_numpy(zero_copy_only=False)
    whole = letters[_run(starts[codes], sizes[codes])].tobytes()
    counts = pc.fill_null(pc.list_value_length(ids), 0).to_numpy()
    ends = np.concatenate(([0], np.cumsum(sizes[codes])))[np.concatenate(([0], np.cumsum(counts)))]
    texts = [whole[a:b].decode("utf-8", "replace") for a, b in zip(ends.tolist(), ends[1:].tolist())]
    return [t[1:] if model.prefix and t[:1] == " " else t for t in texts]


def decoded(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` (doc_id, text, ids) with ``decoded``, the text of the ids."""
    bound_batches(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array(_texts(batch["ids"], shared.value), pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, "decoded"])

    return rows.mapInArrow(run, rows.select("doc_id", "text", "ids", F.lit("").alias("decoded")).schema)


def tokens(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """doc_id, ids, n_tokens, round_trip (the ids decode to the text). Decoded where they are encoded."""

    def finish(part: pa.RecordBatch, ids: pa.ListArray, model: Model) -> list[pa.Array]:
        same = [d == (t or "").replace(BLANK, " ") for d, t in zip(_texts(ids, model), part["text"].to_pylist())]
        return [part["doc_id"], ids, pc.list_value_length(ids), pa.array(same, pa.bool_())]

    return _encoded(docs, read_model(path), FREQUENT, finish, "doc_id long, ids array<int>, n_tokens int, round_trip boolean")
