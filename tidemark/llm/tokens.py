"""Training-order materialisation of token ids.

The texts, each with an end mark, are one line of tokens in the order in which the table's files hold them (by file, then
row), and the line is cut into sequences of fixed length. A keyed Feistel permutation with cycle-walking over the exact
number of sequences gives each its global slot. Ranges of slots are shards; a shard is a file of records of one stride: a
4-byte count of tokens that are not padding, then the ids as little-endian 16-bit numbers. So slot k is record k % records
of shard k // records, and a reader that has seen k sequences goes on there.

A first pass counts the tokens of each run of rows that a task reads from one file; their sums give every run its place on
the line. A second pass cuts the runs, checks that they are as counted, and sends each piece to the partition that is its
range of slots, where the pieces of a sequence that two runs share are put together. The corpus moves once, as compressed
sequences. The order does not depend on how the files are split into tasks, nor on the cluster. Files count if the
committed index names them.

Defined results: a null text is empty and has only the end mark; repeated rows are documents of their own; ids of any type
may be null and are kept in the lists; very long texts go over as many sequences as they fill; other columns are ignored,
whatever their names; a table that is not read from files is written first, and its order is that of the copy; an empty
table gives no sequences.
"""

from __future__ import annotations

import base64
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import zstandard
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.files import _filesystem, attempt_name, open_input, open_output, shared_dir, written
from tidemark.llm.textscan import WordScanner, column_bytes, mix, slices

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how the vocabulary's makers cut a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END_OF_TEXT = 50256
#: Pieces of text whose ids a worker remembers between slices; a slice with more has a table of its own.
REMEMBERED = 600_000
#: A shard has RECORDS[0] records at least and RECORDS[1] at most; in between their number grows as that of the shards does.
RECORDS = (64, 1 << 16)
#: Groups of files whose runs a task of the second pass looks up together.
RUN_GROUPS = 64


class PieceTokenizer:
    """Token ids of many texts at once: a text is cut where no merge can cross, and equal pieces are encoded once.

    A cut lies before a space that follows anything and is followed by a character that is surely no white space;
    the pattern always starts a new part there, so pieces that begin so are encoded in one call and told apart by
    the lengths of their tokens.
    """

    def __init__(self, vocabulary: str = VOCABULARY):
        import tiktoken

        with open_input(vocabulary) as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f.read().splitlines() if line)}
        self.encoder = tiktoken.Encoding("pieces", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.length = np.zeros(max(ranks.values()) + 1, np.int64)
        self.length[list(ranks.values())] = [len(x) for x in ranks]
        self.scanner = WordScanner(b"", fold=False)
        self.solid = np.zeros(256, bool)
        self.solid[0x21:0x7F] = True
        self.solid[0xC3:0xF5] = True
        self.solid[[0xE1, 0xE2, 0xE3]] = False
        self._forget()

    def _forget(self, most: int = 0):
        """An empty table with room for ``most`` pieces, and for REMEMBERED at least."""
        bits = max(10, int(2 * max(REMEMBERED, most)).bit_length())
        self.keys, self.values, self.mask = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32), np.uint64((1 << bits) - 1)
        self.ids, self.begin, self.count = np.zeros(1 << 20, np.uint16), np.zeros(1 << 18, np.int64), 0

    @property
    def known(self) -> np.ndarray:
        """The hashes of the pieces that are remembered."""
        return self.keys[self.keys != 0]

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each piece, -1 where it is not known."""
        out = np.full(len(hashes), -1, np.int64)
        left, step = np.arange(len(hashes)), np.uint64(0)
        while len(left):
            slot = (hashes[left] + step) & self.mask
            key = self.keys[slot]
            hit = key == hashes[left]
            out[left[hit]] = self.values[slot[hit]]
            left = left[~hit & (key != 0)]
            step += np.uint64(1)
        return out

    def _insert(self, hashes: np.ndarray, numbers: np.ndarray):
        step = np.uint64(0)
        while len(hashes):
            slot = (hashes + step) & self.mask
            free = self.keys[slot] == 0
            self.keys[slot[free]] = hashes[free]  # of several that want one place, the last has it
            placed = self.keys[slot] == hashes
            self.values[slot[placed]] = numbers[placed]
            hashes, numbers = hashes[~placed], numbers[~placed]
            step += np.uint64(1)

    def _learn(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        size = ends - starts
        upto = np.cumsum(size)
        raw = data[np.repeat(starts - upto + size, size) + np.arange(upto[-1])].tobytes()
        own = (data[starts] == 0x20) & self.solid[data[np.minimum(starts + 1, len(data) - 1)]] & (size > 1)
        if own[1:].all():
            ids = np.array(self.encoder.encode_ordinary(raw.decode("utf-8", "replace")), np.int64)
            stops = np.cumsum(self.length[ids])
            at = np.searchsorted(stops, upto)
            if len(stops) and stops[-1] == upto[-1] and (stops[at] == upto).all():
                self._keep(hashes, ids, np.append(0, at + 1))
                return
        elif not own[0] or not own.all():
            # pieces that begin a text stand alone
            alone = np.flatnonzero(~own)
            if len(alone) < len(own):
                rest = np.flatnonzero(own)
                self._learn(hashes[rest], data, starts[rest], ends[rest])
                hashes, starts, ends = hashes[alone], starts[alone], ends[alone]
        got = [self.encoder.encode_ordinary(data[a:b].tobytes().decode("utf-8", "replace")) for a, b in zip(starts.tolist(), ends.tolist())]
        self._keep(hashes, np.array([x for g in got for x in g], np.int64), np.append(0, np.cumsum([len(g) for g in got])))

    def _keep(self, hashes: np.ndarray, ids: np.ndarray, first: np.ndarray):
        """Remember pieces whose ids are ids[first[k] : first[k + 1]]."""
        used = int(self.begin[self.count])
        if used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), len(ids)), np.uint16)])
        if self.count + len(hashes) + 1 > len(self.begin):
            self.begin = np.concatenate([self.begin, np.zeros(max(len(self.begin), len(hashes) + 1), np.int64)])
        self.ids[used : used + len(ids)] = ids
        self.begin[self.count : self.count + len(first)] = used + first
        self._insert(hashes, np.arange(self.count, self.count + len(hashes)))
        self.count += len(hashes)

    def _pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each piece in turn, and the first piece of each row (and the end)."""
        cut = np.zeros(len(data) + 1, bool)
        if len(data) > 1:
            cut[:-2] = (data[:-1] == 0x20) & self.solid[data[1:]]
        cut[offsets] = True
        starts = np.flatnonzero(cut[:-1])
        ends = np.append(starts[1:], len(data))
        if not len(starts):
            return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
        hashes = np.maximum(self.scanner.hashes(data, starts, ends), np.uint64(1))
        at = self._find(hashes)
        if (missing := np.flatnonzero(at < 0)).size:
            new, example = np.unique(hashes[missing], return_index=True)
            if self.count + len(new) > REMEMBERED:
                # a table for this slice, whatever its size
                new, example = np.unique(hashes, return_index=True)
                missing = np.arange(len(hashes))
                self._forget(len(new))
            self._learn(new, data, starts[missing[example]], ends[missing[example]])
            at = self._find(hashes)
        return at, np.searchsorted(starts, offsets)

    def _spare(self):
        if self.count > REMEMBERED:
            self._forget()

    def count_ids(self, data: np.ndarray, offsets: np.ndarray) -> int:
        """How many ids all rows have."""
        at, _ = self._pieces(data, offsets)
        n = int((self.begin[at + 1] - self.begin[at]).sum())
        self._spare()
        return n

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids, row after row, and each row's first index among them (and the end)."""
        at, first = self._pieces(data, offsets)
        begin, size = self.begin[at], self.begin[at + 1] - self.begin[at]
        upto = np.zeros(len(at) + 1, np.int64)
        np.cumsum(size, out=upto[1:])
        ids = self.ids[np.repeat(begin - upto[:-1], size) + np.arange(upto[-1])]
        self._spare()
        return ids, upto[first]


def feistel(x: np.ndarray, domain: int, key: int, rounds: int = 6) -> np.ndarray:
    """A keyed permutation of [0, domain): a balanced Feistel network on the next even number of bits, walked until inside."""
    half = np.uint64(max(1, -(-max(1, (domain - 1).bit_length()) // 2)))
    low = (np.uint64(1) << half) - np.uint64(1)

    def once(v):
        left, right = v >> half, v & low
        for r in range(rounds):
            left, right = right, left ^ (mix(right + np.uint64((key * 0x9E3779B97F4A7C15 + r * 0xD1B54A32D192ED03) & ((1 << 64) - 1))) & low)
        return (left << half) | right

    out = once(x.astype(np.uint64))
    while (out_of := out >= np.uint64(domain)).any():
        out[out_of] = once(out[out_of])
    return out


class _Runs:
    """Cuts batches of (file, row) into runs of one file with rising rows, over the batches of a task."""

    def __init__(self):
        self.file, self.first, self.last = None, 0, 0

    def of(self, files: pa.Array, rows: np.ndarray):
        """(begin, end, whether a new run begins) of the parts of a batch."""
        n = len(rows)
        new = np.zeros(n, bool)
        if n:
            new[1:] = pc.not_equal(files[1:], files[:-1]).to_numpy(zero_copy_only=False) | (rows[1:] <= rows[:-1])
            new[0] = self.file is None or files[0].as_py() != self.file or rows[0] <= self.last
        cuts = np.unique(np.concatenate([[0], np.flatnonzero(new), [n]])).tolist()
        for a, b in zip(cuts, cuts[1:]):
            yield a, b, bool(new[a])
            if new[a]:
                self.file, self.first = files[a].as_py(), int(rows[a])
            self.last = int(rows[b - 1])


def _count(vocabulary: str):
    """A mapper from (id, text, file, row) to a row for each run: (file, first, last, tokens)."""

    def run(batches):
        tokenizer, runs, total, done = PieceTokenizer(vocabulary), _Runs(), 0, []
        for batch in batches:
            data, offsets = column_bytes(batch.column(1))
            for a, b, new in runs.of(batch.column(2), batch.column(3).to_numpy()):
                if new:
                    if runs.file is not None:
                        done.append((runs.file, runs.first, runs.last, total))
                    total = 0
                for i, j in slices(offsets[a : b + 1]):
                    own = offsets[a + i : a + j + 1]
                    total += tokenizer.count_ids(data[own[0] : own[-1]], own - own[0]) + j - i
        if runs.file is not None:
            done.append((runs.file, runs.first, runs.last, total))
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*done) if done else [()] * 4, kinds)], names=["file", "first", "last", "tokens"])

    return run


class _Line:
    """The places of runs on the line of tokens, from a table that is dealt by groups of files."""

    def __init__(self, folder: str):
        self.folder, self.group, self.held = folder, None, {}

    def place(self, file: str, first: int) -> tuple[int, int]:
        group = zlib.crc32(file.encode()) % RUN_GROUPS
        if group != self.group:
            files, path = _filesystem(f"{self.folder}/g={group}")
            rows = pq.read_table(path, filesystem=files, columns=["file", "first", "tokens", "base"]).to_pylist()
            self.group, self.held = group, {(r["file"], r["first"]): (r["base"], r["tokens"]) for r in rows}
        if (file, first) not in self.held:
            raise RuntimeError(f"the table changed while it was read: {file}, row {first}")
        return self.held[file, first]


def _pack(length: int, sequences: int, records: int, key: int, vocabulary: str, line: str, kind: pa.DataType):
    """A mapper from (id, text, file, row) to pieces of sequences: (shard, slot, begin, n, doc_ids, blob)."""

    def run(batches):
        tokenizer, packer, runs, places = PieceTokenizer(vocabulary), zstandard.ZstdCompressor(3), _Runs(), _Line(line)
        held, have, at, end = [], 0, 0, 0  # (ids, names, ends of the documents), their number, where they begin on the line

        def pieces(last: bool):
            nonlocal held, have, at
            if not have or not last and have < length:
                return
            flat = np.concatenate([h[0] for h in held])
            names = [x for h in held for x in h[1]]
            stops = np.concatenate([h[2] for h in held])
            starts = np.append(0, stops[:-1])
            cuts = [0, *range(length - at % length, have, length)]
            cuts += [have] if last or (at + have) % length == 0 else []
            rows = []
            for a, b in zip(cuts, cuts[1:]):
                own = names[np.searchsorted(stops, a, "right") : np.searchsorted(starts, b, "left")]
                rows.append(((at + a) // length, (at + a) % length, b - a, own, packer.compress(flat[a:b].astype("<u2").tobytes())))
            done = cuts[-1]
            rest = int(np.searchsorted(stops, done, "right"))
            held, have, at = [(flat[done:].copy(), names[rest:], stops[rest:] - done)] if done < have else [], have - done, at + done
            for k in range(0, len(rows), 64):
                number, begin, n, own, blob = zip(*rows[k : k + 64])
                slot = feistel(np.array(number, np.uint64), sequences, key).astype(np.int64)
                cols = [pa.array((slot // records).astype(np.int32)), pa.array(slot), pa.array(begin, pa.int32()), pa.array(n, pa.int32()), pa.array(own, pa.list_(kind)), pa.array(blob, pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, names=["shard", "slot", "begin", "n", "doc_ids", "blob"])

        def ended():
            yield from pieces(True)
            if at != end:
                raise RuntimeError(f"the table changed while it was read: {runs.file}, row {runs.first}")

        for batch in batches:
            data, offsets = column_bytes(batch.column(1))
            names, rows = batch.column(0), batch.column(3).to_numpy()
            for a, b, new in runs.of(batch.column(2), rows):
                if new:
                    yield from ended()
                    base, tokens = places.place(batch.column(2)[a].as_py(), int(rows[a]))
                    at, end = base, base + tokens
                for i, j in slices(offsets[a : b + 1]):
                    own = offsets[a + i : a + j + 1]
                    ids, first = tokenizer.encode(data[own[0] : own[-1]], own - own[0])
                    # one more id after each row
                    flat = np.full(len(ids) + j - i, END_OF_TEXT, np.uint16)
                    flat[np.arange(len(ids)) + np.repeat(np.arange(j - i), np.diff(first))] = ids
                    held.append((flat, names[a + i : a + j].to_pylist(), first[1:] + np.arange(1, j - i + 1) + have))
                    have += len(flat)
                    yield from pieces(False)
        yield from ended()

    return run


def _write(folder: str, length: int, records: int):
    """A mapper over the pieces of whole shards, sorted, that writes them and gives (slot, shard, path, record, n_tokens, doc_ids)."""

    def run(batches):
        unpacker, out, shard, name, held, due = zstandard.ZstdDecompressor(), None, None, "", None, 0
        done = []

        def flush():
            nonlocal out, shard, name, due
            slot, n, ids, parts = held
            if slot // records != shard:
                if out is not None:
                    out.close()
                shard = slot // records
                name = f"{folder}/{attempt_name(f'shard-{shard:06d}')}.bin"
                out = open_output(name)
                due = shard * records
            if slot != due:
                raise RuntimeError(f"slot {due} is missing")
            due += 1
            full = b"".join(parts)
            out.write(n.to_bytes(4, "little") + full + END_OF_TEXT.to_bytes(2, "little") * (length - n))
            done.append((slot, shard, name, slot % records, n, ids))

        def batch_of(kind):
            cols = [pa.array(x, k) for x, k in zip(zip(*done), (pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int32(), kind))]
            done.clear()
            return pa.RecordBatch.from_arrays(cols, names=["slot", "shard", "path", "record", "n_tokens", "doc_ids"])

        for batch in batches:
            kind = batch.column(4).type
            for slot, n, ids, blob in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist(), batch.column(5)):
                part = unpacker.decompress(blob.as_py(), max_output_size=2 * length)
                if held is not None and held[0] == slot:
                    held = slot, held[1] + n, held[2] + ids, [*held[3], part]
                    continue
                if held is not None:
                    flush()
                held = slot, n, ids, [part]
            if done:
                yield batch_of(kind)
        if held is not None:
            flush()
            yield batch_of(kind)
        if out is not None:
            out.close()

    return run


def _located(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, file, row): each document with the file and row that it is read from."""
    place = docs.metadataColumn("_metadata")
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), place["file_path"].alias("file"), place["row_index"].alias("row"))


def materialise(docs: DataFrame, length: int = 8192, shards: int | None = None, key: int = 2024, vocabulary: str = VOCABULARY, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the shards; the index (slot, shard, path, record, n_tokens, doc_ids), one row for each sequence.

    ``shards`` is how many shards there are, about; without it the number follows from that of the sequences.
    """
    spark = docs.sparkSession
    folder = folder or shared_dir(spark, "tokens")

    def counted(rows: DataFrame, name: str) -> DataFrame:
        return written(rows.mapInArrow(_count(vocabulary), "file string, first long, last long, tokens long"), f"{folder}/{name}")

    try:
        rows = _located(docs, id_col, text_col)
        runs = counted(rows, "runs")
        # a row for each split of a file
        line = Window.partitionBy().orderBy("file", "first")
        mixed = not runs.withColumn("before", F.lag(F.struct("file", "last")).over(line)).where("before.file = file and before.last >= first").isEmpty()
    except AnalysisException:
        mixed = True
    if mixed:
        copy = written(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")), f"{folder}/copy")
        rows = _located(copy, "id", "text")
        runs = counted(rows, "runs-of-copy")
    kind = rows.schema["id"].dataType
    schema = f"slot long, shard int, path string, record long, n_tokens int, doc_ids array<{kind.simpleString()}>"
    total = runs.agg(F.sum("tokens")).first()[0] or 0
    if not total:
        return spark.createDataFrame([], schema)
    sequences = -(-total // length)
    records = -(-sequences // shards) if shards else int(np.clip(1 << int(4 * np.sqrt(sequences)).bit_length(), *RECORDS))
    base = F.sum("tokens").over(Window.partitionBy().orderBy("file", "first")) - F.col("tokens")
    runs.withColumns({"base": base, "g": F.crc32(F.col("file").cast("binary")) % RUN_GROUPS}).repartition("g").write.partitionBy("g").parquet(f"{folder}/line")
    arrow = rows.select("id").limit(0).toArrow().schema.field("id").type
    packed = rows.mapInArrow(_pack(length, sequences, records, key, vocabulary, f"{folder}/line", arrow), f"shard int, slot long, begin int, n int, doc_ids array<{kind.simpleString()}>, blob binary")
    dealt = packed.repartitionById(-(-sequences // records), F.col("shard")).sortWithinPartitions("slot", "begin")
    return written(dealt.mapInArrow(_write(f"{folder}/shards", length, records), schema), f"{folder}/index")


def _reread(length: int):
    stride = 4 + 2 * length

    def run(batches):
        path, source = None, None
        for batch in batches:
            rows = []
            for name, record in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if name != path:
                    if source is not None:
                        source.close()
                    path, source = name, open_input(name)
                raw = source.read_at(stride, record * stride)
                n = int.from_bytes(raw[:4], "little")
                rows.append((n, zlib.crc32(raw[4 : 4 + 2 * n])))
            cols = [pa.array(x, pa.int64()) for x in (zip(*rows) if rows else [(), ()])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *cols], names=["path", "record", "tokens_read", "tokens_crc32"])
        if source is not None:
            source.close()

    return run


def read_back(index: DataFrame, length: int = 8192) -> DataFrame:
    """Adds what the shards hold at each slot: tokens_read, tokens_crc32 of the ids that are not padding."""
    rows = index.select("path", "record").repartitionByRange("path", "record").sortWithinPartitions("path", "record")
    return index.join(rows.mapInArrow(_reread(length), "path string, record long, tokens_read long, tokens_crc32 long"), ["path", "record"])


def read_tokens(index: DataFrame, from_slot: int, length: int = 8192):
    """Sequences from ``from_slot`` on, in training order, as numpy arrays: what a trainer resumes with."""
    for row in index.where(F.col("slot") >= from_slot).orderBy("slot").select("path", "record", "n_tokens").toLocalIterator():
        with open_input(row.path) as source:
            yield np.frombuffer(source.read_at(2 * row.n_tokens, row.record * (4 + 2 * length) + 4), "<u2")
