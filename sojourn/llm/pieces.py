"""Operator 11: SentencePiece encoding and decoding for merge-type vocabularies.

A text is cut to characters; every adjacent pair of symbols that the vocabulary holds as one piece
stands on an agenda ordered by score, ties from the left; the best pair is merged, and the pairs it
makes with its neighbours join the agenda, until it is empty. Characters without a piece become
their bytes. Texts are first parted where no piece reaches across (before a space mark, and around
characters that stand in no longer piece). Parts do not meet, so all parts that are new in a slice
of texts go through their agendas together, the best pair of each in one step; a long part has an
agenda of its own, a heap. A worker keeps short parts, so a word of a third of all texts costs one
lookup each time. Parts newly coded in an Arrow batch are checked there against the sentencepiece
library; a difference fails the task.

Decoding goes from ids alone: pieces are joined, runs of byte pieces are read as UTF-8, space marks
become spaces and the one that encoding put in front goes.

Cases: a null or empty text has no ids and decodes to the empty text; a text without a space, of any
length, is one part and goes through the agenda whole; rows alike are coded alike; an empty table
gives an empty table; of other columns only doc_id is read and kept.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

MARK = "▁"
#: Parts of up to so many characters are coded together and kept, up to so many for each worker (some 150 MB).
SHORT, KEPT = 32, 500_000
#: Bytes of text that are coded before a batch of results goes out.
OUT = 4 << 20


class Vocabulary:
    """The pieces of a merge-type model with their scores, and the agenda that codes one part."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        model, size = self.library, self.library.vocab_size()
        names = [model.id_to_piece(i) for i in range(size)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i) for i in range(size)]
        self.ids = {name: i for i, name in enumerate(names) if not special[i]}
        self.scores = {name: model.get_score(i) for name, i in self.ids.items()}
        self.bytes = {int(names[i][3:5], 16): i for i in range(size) if model.is_byte(i)}
        self.unknown = model.unk_id()
        self.surface = [None if model.is_control(i) else names[i] for i in range(size)]
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.plain = [None if i in self.byte_of or i == self.unknown else (name or "").replace(MARK, " ") for i, name in enumerate(self.surface)]
        self.table = self.merges()
        joined = set("".join(name for name in self.ids if len(name) > 1))
        if any(re.search(f"[^{MARK}]{MARK}", name) for name in self.ids):
            raise ValueError("pieces with a space mark after another character are not supported")
        for probe in ("a  b ", " ﬁ Å Ａ\n", "é"):
            if model.normalize(probe) != MARK + probe.replace(" ", MARK):
                raise ValueError("only models without normalisation, with a space mark in front, are supported")
        alone = "".join(c for c in map(chr, range(128)) if c not in joined and c != " ")
        self.parts = re.compile(f"{MARK}*[^{MARK}{re.escape(alone)}]+|{MARK}+|[{re.escape(alone)}]").findall
        #: A character that stays by itself, to part what is checked from the mark that the library puts in front.
        self.fence = next((c for c in "\n\t\r\x01" if c in alone), None)
        self.front = self.library.encode(self.fence) if self.fence else []

    def merges(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs of symbols as sorted keys, the symbol each makes and its score; symbols are ids, or numbers behind them for characters without a piece."""
        found = {}
        for name, i in self.ids.items():
            for cut in range(1, len(name)):
                left, right = self.symbol(name[:cut]), self.symbol(name[cut:])
                if left is not None and right is not None:
                    found[left << 32 | right] = (i, self.scores[name])
        keys = np.array(sorted(found), np.int64)
        return keys, np.array([found[k][0] for k in keys.tolist()], np.int64), np.array([found[k][1] for k in keys.tolist()])

    def symbol(self, text: str) -> int | None:
        """Number of a piece or of a single character."""
        known = self.ids.get(text)
        return len(self.surface) + ord(text) if known is None and len(text) == 1 else known

    def agendas(self, parts: list[str]) -> list[list[int]]:
        """Ids of short parts: in each step the best pair of every part that has one is merged."""
        sizes = np.array([len(p) for p in parts])
        order = np.argsort(sizes, kind="stable")
        coded: list[list[int]] = [[]] * len(parts)
        for chosen in np.split(order, np.flatnonzero(np.diff(sizes[order])) + 1):
            width = int(sizes[chosen[0]])
            points = np.frombuffer("".join([parts[i] for i in chosen]).encode("utf-32-le"), "<u4").reshape(-1, width)
            rows = np.append(self.symbol_of(points), np.full((len(chosen), 1), -1), 1)
            made, scores = self.pairs(rows[:, :-1], rows[:, 1:])
            # columns: pair j is symbols j and j + 1; the last one never merges
            live, steps = np.arange(len(chosen)), np.arange(width + 1)
            while len(live):
                best = np.argmax(scores[live], 1)  # the first of the best: ties from the left
                has = scores[live, best] > -np.inf
                live, best = live[has], best[has]
                if not len(live):
                    break
                symbols, pair_of, score_of = rows[live], made[live], scores[live]
                at = np.arange(len(live))
                symbols[at, best] = pair_of[at, best]
                shift = np.minimum(steps + (steps > best[:, None]), width)
                symbols = np.take_along_axis(symbols, shift, 1)
                symbols[:, -1] = -1
                pair_of, score_of = (np.take_along_axis(x, np.minimum(shift[:, :-1], width - 1), 1) for x in (pair_of, score_of))
                score_of[:, -1] = -np.inf
                for place in (best - 1, best):
                    ok = place >= 0
                    made_here, score_here = self.pairs(symbols[at[ok], place[ok]], symbols[at[ok], place[ok] + 1])
                    pair_of[at[ok], place[ok]], score_of[at[ok], place[ok]] = made_here, score_here
                rows[live], made[live], scores[live] = symbols, pair_of, score_of
            count = (rows >= 0).sum(1)
            for i, row, n in zip(chosen.tolist(), rows.tolist(), count.tolist(), strict=True):
                coded[i] = row[:n]
            known = len(self.surface)
            for j in np.flatnonzero((rows >= known).any(1)):
                coded[chosen[j]] = self.spelled([chr(x - known) if x >= known else x for x in coded[chosen[j]]])
        return coded

    def symbol_of(self, points: np.ndarray) -> np.ndarray:
        """Symbols of code points."""
        distinct, which = np.unique(points, return_inverse=True)
        return np.array([self.symbol(chr(x)) for x in distinct.tolist()], np.int64)[which.reshape(points.shape)]

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What pairs of symbols make, and its score; minus infinity where nothing."""
        keys, made, scores = self.table
        wanted = left << 32 | np.maximum(right, 0)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        hit = (keys[at] == wanted) & (right >= 0) & (left >= 0)
        return made[at], np.where(hit, scores[at], -np.inf)

    def spelled(self, symbols: list[int | str]) -> list[int]:
        """Ids, with characters that have none as their bytes or, without byte pieces, a run of them as one unknown."""
        out: list[int] = []
        for symbol in symbols:
            if isinstance(symbol, int):
                out.append(symbol)
            elif self.bytes:
                out.extend(self.bytes[b] for b in symbol.encode("utf-8"))
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return out

    def agenda(self, part: str) -> list[int]:
        """Ids of one part of any length, by a heap."""
        symbols = list(part)
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        scores, agenda = self.scores, []

        def propose(left: int, right: int) -> None:
            pair = symbols[left] + symbols[right]
            score = scores.get(pair)
            if score is not None:
                heapq.heappush(agenda, (-score, left, right, len(pair)))

        for left in range(n - 1):
            propose(left, left + 1)
        while agenda:
            _, left, right, size = heapq.heappop(agenda)
            # a symbol merged away is empty; one that has grown makes another length
            if not symbols[left] or not symbols[right] or len(symbols[left]) + len(symbols[right]) != size:
                continue
            symbols[left] += symbols[right]
            symbols[right] = ""
            after[left] = after[right]
            if after[left] < n:
                before[after[left]] = left
                propose(left, after[left])
            if before[left] >= 0:
                propose(before[left], left)
        return self.spelled([self.ids.get(s, s) for s in symbols if s])

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids: space marks become spaces, the first one in front goes."""
        out: list[str] = []
        run = bytearray()
        bare = True  # nothing written and no mark taken yet
        for i in ids:
            byte = self.byte_of.get(i)
            if byte is not None:
                run.append(byte)
                bare = False
                continue
            if run:
                out.append(read_bytes(bytes(run)))
                run.clear()
            piece = self.surface[i]
            if piece is None:
                continue
            if i == self.unknown:
                piece = " ⁇ "
            elif bare and piece.startswith(MARK):
                piece, bare = piece[1:], False
            bare = bare and not piece
            out.append(piece.replace(MARK, " "))
        if run:
            out.append(read_bytes(bytes(run)))
        return "".join(out)

    def check(self, parts: list[str], coded: list[list[int]]) -> None:
        """Raise if the library codes one of the parts otherwise."""
        if self.fence is None:
            return
        skip = len(self.front)
        for part, own, theirs in zip(parts, coded, self.library.encode([self.fence + p for p in parts], num_threads=1), strict=True):
            if own != theirs[skip:]:
                raise ValueError(f"the sentencepiece library codes {part[:80]!r} otherwise")


def read_bytes(run: bytes) -> str:
    """UTF-8, with a replacement character for every byte that belongs to no character."""
    out, at = [], 0
    while at < len(run):
        try:
            out.append(run[at:].decode("utf-8"))
            break
        except UnicodeDecodeError as wrong:
            out.append(run[at : at + wrong.start].decode("utf-8") + "�")
            at += wrong.start + 1
    return "".join(out)


class Coder:
    """Codes texts part by part and keeps short parts: their ids as bytes, and what these decode to within a text."""

    def __init__(self, path: str) -> None:
        self.vocabulary = Vocabulary(path)
        self.ids: dict[str, bytes] = {}
        self.texts: dict[str, str] = {}

    def learn(self, parts: list[str], check: bool) -> None:
        """Code parts not met lately, and check them against the library."""
        own = self.vocabulary
        short, long = [p for p in parts if len(p) <= SHORT], [p for p in parts if len(p) > SHORT]
        coded = (own.agendas(short) if short else []) + [own.agenda(p) for p in long]
        if check:
            own.check(short + long, coded)
        plain = own.plain.__getitem__
        for part, ids in zip(short + long, coded, strict=True):
            self.ids[part] = array("i", ids).tobytes()
            try:
                self.texts[part] = "".join(map(plain, ids))
            except TypeError:  # byte pieces are read together; behind another character a mark in front stays a space
                self.texts[part] = own.decode([*own.front, *ids])[len(own.fence or "") :]

    def code(self, texts: list[str], check: bool = True) -> tuple[list[bytes], list[str]]:
        """Ids of whole texts as 32-bit numbers, and what they decode to."""
        parts = [self.vocabulary.parts(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        fresh = set().union(*parts).difference(self.ids)
        if len(self.ids) + len(fresh) > KEPT:
            self.ids.clear()
            self.texts.clear()
            fresh = set().union(*parts)
        self.learn(list(fresh), check)
        ids, decoded = self.ids.__getitem__, self.texts.__getitem__
        found = [b"".join(map(ids, p)) for p in parts], ["".join(map(decoded, p))[1:] for p in parts]
        for part in [p for p in fresh if len(p) > SHORT]:
            del self.ids[part], self.texts[part]
        return found


@lru_cache(maxsize=2)
def coder(path: str) -> Coder:
    return Coder(path)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


IDS = T.StructField("ids", T.ArrayType(T.IntegerType(), False))


def encode(docs: DataFrame, model: str | None = None, check: bool = True) -> DataFrame:
    """doc_id, ids and decoded of every row, for the model file, which must be there on every executor."""
    path = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path)
        for batch in batches:
            for first, last, _, _ in common.slices(batch.column(1), OUT):
                coded, decoded = own.code(batch.column(1).slice(first, last - first).to_pylist(), check)
                at = np.concatenate([[0], np.cumsum([len(i) >> 2 for i in coded])])
                ids = pa.array(np.frombuffer(b"".join(coded), np.int32))
                columns = [batch.column(0).slice(first, last - first), pa.ListArray.from_arrays(pa.array(at, pa.int32()), ids), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"])

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), IDS, T.StructField("decoded", T.StringType())])
    return docs.select("doc_id", common.text_or_empty().alias("text")).mapInArrow(run, schema)


def decode(coded: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id and decoded of rows with an array of ids; a null array counts as an empty one."""
    path = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = coder(path).vocabulary
        for batch in batches:
            texts = [vocabulary.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "decoded"])

    schema = T.StructType([T.StructField("doc_id", coded.schema["doc_id"].dataType), T.StructField("decoded", T.StringType())])
    return coded.select("doc_id", F.col("ids").cast("array<int>")).mapInArrow(run, schema)


def compare_with_library(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, same_ids, same_decoded: whole texts coded and decoded here and by the library, in Arrow batches."""
    path = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path)
        for batch in batches:
            for first, last, _, _ in common.slices(batch.column(1), OUT):
                texts = batch.column(1).slice(first, last - first).to_pylist()
                theirs = own.vocabulary.library.encode(texts, num_threads=1)
                coded, texts = own.code(texts)
                ids = [np.frombuffer(i, np.int32).tolist() == t for i, t in zip(coded, theirs, strict=True)]
                decoded = [d == own.vocabulary.library.decode(t) for d, t in zip(texts, theirs, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), pa.array(ids), pa.array(decoded)], names=["doc_id", "same_ids", "same_decoded"])

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("same_ids", T.BooleanType()), T.StructField("same_decoded", T.BooleanType())])
    return docs.select("doc_id", common.text_or_empty().alias("text")).mapInArrow(run, schema)


def op11_piece_agenda(spark, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded text of every document."""
    coded = encode(common.table(spark, sf_dir, "documents"))
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
