"""SentencePiece (BPE) encoding and decoding by a table over prefixes.

A piece sequence is the result of the merges exactly if every adjacent pair is compatible: the merges
of both pieces' characters, taken together, end in these two pieces.  So each prefix of a text has one
last piece: of the vocabulary's pieces that end there (an Aho-Corasick automaton finds them), the one
that is compatible with the last piece of what is before it.  The table is filled from left to right and
the ids are read backwards, in time linear in the text.  Of merges with equal scores, as those of spaces
have, the leftmost comes first.

Merges never cross a place where no piece of the model has the two characters next to each other, so a text
is cut there, and units are looked up in a bounded table, a batch at a time.  Null and empty texts have no ids;
texts of any length are encoded whole; repeated rows are rows of their own; an empty table gives an empty
result; further columns pass through ``encode`` (names that it adds are replaced).
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinsift.llm.textkit import slices, text_bytes
from kinsift.llm.units import UnitTable

SPACE = "▁"
PAIRS = 1_000_000


class PieceCodec:
    """Encodes and decodes as sentencepiece does for a BPE model with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = len(model)
        special = {i for i in range(n) if model.is_control(i) or model.is_unknown(i) or model.is_byte(i)}
        self.piece = [model.id_to_piece(i) for i in range(n)]
        self.special = special
        self.length = [len(p) for p in self.piece]
        self.byte = {int(self.piece[i][3:5], 16): i for i in special if model.is_byte(i)}
        self.of_byte = {v: k for k, v in self.byte.items()}
        self.id = {self.piece[i]: i for i in range(n) if i not in special}
        if any(SPACE in p.lstrip(SPACE) for p in self.id):
            raise ValueError("a piece has a space after another character; texts can't be cut into units")
        self.score = [model.get_score(i) for i in range(n)]
        longer = [p for p in self.id.values() if len(self.piece[p]) > 1]
        place = {x: r for r, x in enumerate(sorted({self.score[i] for i in longer}, reverse=True), 1)}
        self.rank = [0] * n  # equal scores share a rank
        for i in longer:
            self.rank[i] = place[self.score[i]]
        self.split: dict[int, tuple[int, int] | None] = {}
        self.pairs: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        for text, i in self.id.items():
            if self.parts(i) is not False:
                self.automaton.add_word(text, (i, len(text)))
        self.automaton.make_automaton()
        self.table = UnitTable(self.solve, "i4")
        #: Whether a piece has two characters next to each other, by byte; all characters beyond ASCII count as one.
        self.joined = np.zeros((256, 256), bool)
        kind = lambda ch: slice(32, 33) if ch == SPACE else slice(ord(ch), ord(ch) + 1) if ch < "\x80" else slice(128, 256)
        for text in self.id:
            for x, y in zip(text, text[1:]):
                self.joined[kind(x), kind(y)] = True
        self.joined[:, 0x80:0xC0] = True  # inside a character

    def merge(self, text: str) -> list[int | str]:
        """The merges done one by one: the best score first, then the leftmost. Characters without a piece stay as they are."""
        return [self.id.get(x, x) for x in self._merge(text)[0]]

    def _merge(self, text: str) -> tuple[list[str], tuple[str, str] | None]:
        symbols: list[str] = list(text)
        after, before = list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
        heap: list[tuple[float, int, int, str]] = []
        last = None

        def offer(a: int, b: int) -> None:
            if a >= 0 and b < len(symbols) and (i := self.id.get(symbols[a] + symbols[b])) is not None:
                heapq.heappush(heap, (-self.score[i], a, b, symbols[a] + symbols[b]))

        for i in range(len(symbols) - 1):
            offer(i, i + 1)
        while heap:
            _, a, b, both = heapq.heappop(heap)
            if not symbols[a] or after[a] != b or not symbols[b] or symbols[a] + symbols[b] != both:
                continue
            last = symbols[a], symbols[b]
            symbols[a], symbols[b] = both, ""
            after[a] = after[b]
            if after[b] < len(symbols):
                before[after[b]] = a
            offer(before[a], a)
            offer(a, after[a])
        return [s for s in symbols if s], last

    def parts(self, i: int) -> tuple[int, int] | None | bool:
        """The two pieces that piece i was merged from; None for a character, False if no merges end in it."""
        if i not in self.split:
            text = self.piece[i]
            if len(text) == 1:
                self.split[i] = None
            else:
                symbols, last = self._merge(text)
                known = last is not None and symbols == [text] and last[0] in self.id and last[1] in self.id
                self.split[i] = (self.id[last[0]], self.id[last[1]]) if known else False
        return self.split[i]

    def compatible(self, left: int, right: int) -> bool:
        """Whether no merge across the border comes before those that make the two pieces.

        Walks back through the merges of both, the latest first; a piece that joins what stands at the
        border by then, and comes before the merge undone last, would have taken them.
        """
        a, b, rank, piece, ids = left, right, self.rank, self.piece, self.id
        bound: float = float("inf")
        fine = True
        while True:
            joined = ids.get(piece[a] + piece[b])
            if joined is not None and rank[joined] < bound:
                fine = False
                break
            if rank[a] > rank[b]:
                bound, a = rank[a], self.parts(a)[1]
            elif rank[b]:
                bound, b = rank[b] + 0.5, self.parts(b)[0]
            else:
                break
        if len(self.pairs) > PAIRS:
            self.pairs.clear()
        self.pairs[left << 20 | right] = fine
        return fine

    def unit(self, text: str) -> list[int | str]:
        """The pieces of one unit."""
        last = [-1] * (len(text) + 1)  # -1: the character before has no piece, and goes with any
        known = self.pairs.get
        for end, (i, size) in self.automaton.iter(text):
            if last[end + 1] < 0:
                before = last[end + 1 - size]
                fine = before < 0 or known(before << 20 | i)
                if fine is None:
                    fine = self.compatible(before, i)
                if fine:
                    last[end + 1] = i
        out: list[int | str] = []
        to = len(text)
        while to:
            i = last[to]
            out.append(text[to - 1] if i < 0 else i)
            to -= 1 if i < 0 else self.length[i]
        return out[::-1]

    def ids(self, pieces: list[int | str]) -> list[int]:
        if not any(isinstance(x, str) for x in pieces):
            return pieces
        return [i for x in pieces for i in ([self.byte[b] for b in x.encode()] if isinstance(x, str) else [x])]

    def solve(self, units: list[bytes]) -> list[list[int]]:
        """The ids of each unit; -1 - id where the unit decodes to something else."""
        out = []
        for unit in units:
            text = unit.decode()
            ids = self.ids(self.unit(text.replace(" ", SPACE)))
            out.append(ids if self.surface(ids) == text else [-1 - i for i in ids])
        return out

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """The ids of all texts, one after another, how many each has, and what each decodes to."""
        column = pc.replace_substring(pc.fill_null(column, ""), SPACE, " ")
        data, offsets = text_bytes(column)
        full = offsets[:-1][offsets[1:] > offsets[:-1]]
        prefixed = np.insert(data, full, 32)
        at = full + np.arange(len(full))  # where texts begin, with the space that is put before them
        begin = np.zeros(len(prefixed), bool)
        begin[1:] = ~self.joined[prefixed[:-1], prefixed[1:]]
        begin[at] = True
        starts = np.flatnonzero(begin)
        flat, counts = self.table.runs(self.table.find(prefixed, starts, np.append(starts[1:], len(prefixed)).astype(np.int64)))
        of = np.zeros(len(offsets), np.int64)
        of[1:] = np.cumsum(offsets[1:] > offsets[:-1])
        places = np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(starts, np.append(at, len(prefixed)))][of]
        odd = np.flatnonzero(np.diff(np.concatenate([[0], np.cumsum(flat < 0)])[places])).tolist()
        flat = np.where(flat < 0, -1 - flat, flat)
        if odd:
            texts = column.to_pylist()
            for i in odd:
                texts[i] = self.decode(flat[places[i] : places[i + 1]].tolist())
            column = pa.array(texts, pa.string())
        return flat, np.diff(places), column

    def encode(self, text: str | None) -> list[int]:
        return self.encode_column(pa.array([text], pa.string()))[0].tolist()

    def surface(self, ids: list[int]) -> str:
        """The text of ids, with the space that encoding puts before it."""
        if self.special.isdisjoint(ids):
            return "".join([self.piece[i] for i in ids]).replace(SPACE, " ")
        out: list[str] = []
        run = bytearray()
        for i in ids:
            if i in self.of_byte:
                run.append(self.of_byte[i])
                continue
            if run:
                out.append(run.decode(errors="replace"))
                run.clear()
            out.append("" if i in self.special else self.piece[i])
        out.append(run.decode(errors="replace"))
        return "".join(out).replace(SPACE, " ")

    def decode(self, ids: list[int]) -> str:
        return self.surface(ids).removeprefix(" ")


_codecs: dict[str, PieceCodec] = {}


def codec(path: str) -> PieceCodec:
    """One codec for a model file and Python worker."""
    if path not in _codecs:
        _codecs[path] = PieceCodec(path)
    return _codecs[path]


def encode(docs: DataFrame, model: str) -> DataFrame:
    """docs with piece_ids array<int> and decoded string (what the ids stand for)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        for batch in slices(batches):
            values, counts, decoded = c.encode_column(batch.column(batch.schema.get_field_index("text")))
            ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(values))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids, decoded], [*batch.schema.names, "piece_ids", "decoded"])

    docs = docs.drop("piece_ids", "decoded")
    schema = T.StructType(list(docs.schema)).add("piece_ids", T.ArrayType(T.IntegerType())).add("decoded", "string")
    return docs.mapInArrow(run, schema)


def hexes(texts: pa.Array) -> pa.Array:
    data, offsets = text_bytes(texts)
    raw = memoryview(data.tobytes())
    return pa.array([hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)], pa.string())


def digest(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of whole texts; a map without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        for batch in slices(batches):
            values, counts, decoded = c.encode_column(batch.column("text"))
            decimal = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pc.cast(pa.array(values), pa.string()))
            hashes = [hexes(pc.binary_join(decimal, ",")), hexes(decoded)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), *hashes], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op7_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all documents' ids and of what these decode to."""
    return digest(spark.read.parquet(f"{sf_dir}/documents.parquet"), model_path())
