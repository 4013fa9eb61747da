"""Vector bin packing of token sequences for instruction data.

Every example is a vector of tokens, segments (1) and loss-bearing tokens; a
sequence has a limit for each.  Examples of more than a whole sequence are cut
at the sequence length first.  What remains is packed by the dot-product
heuristic: one sequence is open at a time, and of the examples that fit in all
dimensions the one with the largest dot product of its vector with the room
left (both as shares of the limits) goes in.  When nothing fits whole, and
cutting is allowed, an example is cut to fill the room; so padding arises only
where another limit is reached before the tokens, and in the last sequence of
a task.

Packing needs no shuffle.  Each task packs the examples that it reads, in
windows of bounded size, and carries the open sequence and the leftovers from
one window to the next.  Sequence ids are the task's partition number and a
running number, so a task that is run again after a lost executor gives the
same rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanwright.llm.common import bounded_batches

LENGTH = 4096
END = 2
#: Examples that are open for packing at once in a task.
WINDOW = 512
#: Distinct chunks that are encoded at once; chunks of a text whose ids are put together at once.
AT_ONCE, RUN = 50_000, 1 << 20
#: Most segments and loss-bearing tokens of one sequence.
SEGMENTS, LOSS = 16, 3968


class WordTokenizer:
    """The ids of a ``tokenizers`` file, looked up once for each distinct chunk
    between blanks of a batch of texts, and remembered for up to ``most`` chunks.

    The vocabulary's normaliser and split make a chunk's ids independent of its
    surroundings.  Latin text only needs lower case, as its composed letters are
    their own normal form; other text goes through the library's normaliser, and
    text with the string of a special token through its encoder.  Chunks are
    remembered in Arrow and NumPy arrays; when these are full, the chunks that
    no later batch had are dropped.
    """

    #: Fixed value: the split of the vocabulary file.
    SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    #: Characters of text that is not Latin, and the separators U+1C to U+1F, at which only a split by Arrow cuts.
    OTHER = r"[^\x00-\x1b\x20-\x{12f}\x{131}-\x{24f}]"

    def __init__(self, path: str, most: int = 300_000):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.bare = Tokenizer.from_file(path)
        self.bare.normalizer = None
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        vocabulary = self.whole.get_vocab()
        #: Whether an id ends a word.
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.most = most
        #: Remembered chunks, their ids, the number of each one's ids, and whether a later batch had it.
        self.known, self.data, self.sizes = pa.array([], pa.string()), np.empty(0, "<u4"), np.empty(0, np.int64)
        self.again = np.empty(0, bool)

    def _chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all chunks, and the number of each one's ids."""
        words = pc.count_substring_regex(chunks, self.SPLIT).to_numpy().astype(np.int64)
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(chunks)], pa.int32()), chunks), " ")[0].as_py()
        ids = np.array(self.bare.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
        ends = np.concatenate([[0], np.flatnonzero(self.last[ids]) + 1])
        if len(ends) != words.sum() + 1:  # the library cuts some word: another version of Unicode
            each = [e.ids for e in self.bare.encode_batch_fast(chunks.to_pylist(), add_special_tokens=False)]
            return np.array([i for e in each for i in e], "<u4"), np.array([len(e) for e in each], np.int64)
        return ids, np.diff(ends[np.concatenate([[0], np.cumsum(words)])])

    def _look_up(self, chunks: pa.Array) -> np.ndarray:
        """The place of each of the distinct chunks among the remembered ones."""
        if len(self.known) > self.most:
            stay = self.again if self.again.sum() <= self.most // 2 else np.zeros(len(self.known), bool)
            self.data = self.data[np.repeat(stay, self.sizes)]
            self.known, self.sizes = self.known.filter(pa.array(stay)), self.sizes[stay]
            self.again = np.zeros(len(self.known), bool)
        at = pc.index_in(chunks, value_set=self.known)
        new, at = chunks.filter(pc.is_null(at)), pc.fill_null(at, -1).to_numpy().astype(np.int64)
        self.again[at[at >= 0]] = True
        at[at < 0] = np.arange(len(self.known), len(self.known) + len(new))
        found = [self._chunks(new[i : i + AT_ONCE]) for i in range(0, len(new), AT_ONCE)]
        self.known = pa.concat_arrays([self.known, new])
        self.data = np.concatenate([self.data, *(ids for ids, _ in found)])
        self.sizes = np.concatenate([self.sizes, *(n for _, n in found)])
        self.again = np.concatenate([self.again, np.zeros(len(new), bool)])
        return at

    def _odd(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4")
        words = regex.findall(self.SPLIT, self.whole.normalizer.normalize_str(text))
        distinct = {w: i for i, w in enumerate(dict.fromkeys(words))}
        each = [np.array(e.ids, "<u4") for e in self.bare.encode_batch_fast(list(distinct), add_special_tokens=False)]
        return np.concatenate([np.empty(0, "<u4"), *(each[distinct[w]] for w in words)])

    def of_batch(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text, none of a null one."""
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, self.OTHER)
        for special in self.special:
            odd = pc.or_(odd, pc.match_substring(texts, special))
        parts = pc.utf8_split_whitespace(pc.utf8_lower(pc.if_else(odd, "", texts)))
        numbered = parts.flatten().dictionary_encode()
        places = self._look_up(numbered.dictionary)
        data, sizes = self.data, self.sizes[places]
        firsts = (np.cumsum(self.sizes) - self.sizes)[places]
        at, bounds = numbered.indices.to_numpy(), parts.offsets.to_numpy().tolist()
        for i, (start, end) in enumerate(pairwise(bounds)):
            if odd[i].as_py():
                yield self._odd(texts[i].as_py())
                continue
            runs = []
            for run in range(start, end, RUN):
                chosen = at[run : min(run + RUN, end)]
                lengths = sizes[chosen]
                before = np.cumsum(lengths) - lengths
                runs.append(data[np.repeat(firsts[chosen] - before, lengths) + np.arange(lengths.sum())])
            yield runs[0] if len(runs) == 1 else np.concatenate([np.empty(0, "<u4"), *runs])

    def ids(self, text: str) -> np.ndarray:
        return next(self.of_batch(pa.array([text], pa.string())))


#: One for each file and worker process; Spark uses the processes again.
_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer_of(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


class Packer:
    """Dot-product packing of examples, one open sequence at a time."""

    def __init__(self, length: int = LENGTH, segments: int = SEGMENTS, loss: int = LOSS, cut: bool = True):
        self.limits = np.array([length, segments, loss], np.int64)
        self.cut = cut
        self.length = length
        self.top = self.sequence = -1
        self.room = np.zeros(3, np.int64)
        #: Pieces that wait: (tokens, 1, loss) and (example, start).
        self.vectors = np.empty((0, 3), np.int64)
        self.pieces: list[tuple] = []

    def _next(self) -> None:
        self.top += 1
        self.sequence, self.room = self.top, self.limits.copy()

    def _place(self, example, start: int, tokens: int, loss: int) -> tuple:
        offset = self.length - int(self.room[0])
        self.room -= (tokens, 1, loss)
        return example, start, tokens, self.sequence, offset

    def add(self, examples: list[tuple], flush: bool = False) -> Iterator[tuple]:
        """Pack (example, tokens, share of loss) and yield (example, start, length,
        sequence, offset); all that waits if ``flush``, else down to half a window."""
        new = []
        for example, tokens, loss in examples:
            if tokens > self.length and not self.cut:
                raise ValueError("an example is larger than a sequence and may not be cut")
            whole = tokens // self.length if loss <= self.limits[2] / self.length else 0
            for i in range(whole):
                # A whole sequence by itself; the open one stays open.
                self.top += 1
                yield example, i * self.length, self.length, self.top, 0
            if tokens > whole * self.length:
                rest = tokens - whole * self.length
                new.append((rest, int(round(rest * loss)), example, whole * self.length))
        if new:
            self.vectors = np.concatenate([self.vectors, np.array([(t, 1, w) for t, w, _, _ in new], np.int64)])
            self.pieces += [(example, start) for _, _, example, start in new]
        yield from self._pack(0 if flush else WINDOW // 2)

    def _pack(self, keep: int) -> Iterator[tuple]:
        alive = np.ones(len(self.pieces), bool)
        left = len(self.pieces)
        while left > keep:
            if self.sequence < 0 or not self.room[0] or not self.room[1]:
                self._next()
            fits = alive & (self.vectors <= self.room).all(axis=1)
            if fits.any():
                tokens, one, loss = self.vectors.T
                x, y, z = (self.room / self.limits / self.limits).tolist()
                score = tokens * x + one * y + loss * z
                best = int(np.argmax(np.where(fits, score, -1.0)))
                tokens, _, loss = self.vectors[best]
                yield self._place(*self.pieces[best], int(tokens), int(loss))
                alive[best] = False
                left -= 1
            elif self.cut and (part := self._part(alive)):
                best, tokens, loss = part
                example, start = self.pieces[best]
                yield self._place(example, start, tokens, loss)
                self.pieces[best] = (example, start + tokens)
                self.vectors[best] -= (tokens, 0, loss)
            else:
                if (self.room == self.limits).all():
                    raise ValueError("an example is larger than a sequence and may not be cut")
                self._next()
        self.vectors = self.vectors[alive]
        self.pieces = [p for p, a in zip(self.pieces, alive, strict=True) if a]

    def _part(self, alive: np.ndarray) -> tuple | None:
        """The largest example, and as much of it as the room holds."""
        best = int(np.argmax(np.where(alive, self.vectors[:, 0], -1)))
        tokens, _, loss = map(int, self.vectors[best])
        part = min(int(self.room[0]), tokens)
        if loss:
            part = min(part, int(self.room[2]) * tokens // loss)
        if part <= 0:
            return None
        return best, part, min(loss, int(self.room[2]), -(-loss * part // tokens))


def _pieces(batches, path: str, limits: tuple[int, int, int], end: int):
    tokenizer = tokenizer_of(path)
    packer = Packer(*limits)
    context = TaskContext.get()
    base = (context.partitionId() if context else 0) << 32
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def rows(examples: list[tuple], flush: bool = False):
        out = []
        for (doc_id, ids), start, length, sequence, offset in packer.add(examples, flush):
            crc = zlib.crc32(ids[start : start + length])
            out.append((doc_id, start, length, crc, len(ids), base + sequence, offset))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=names)

    tail = np.array([end], "<u4")
    waiting: list[tuple] = []
    for batch in batches:
        ids, texts, shares = batch.column(0), batch.column(1), batch.column(2)
        for doc_id, found, share in zip(ids, tokenizer.of_batch(texts), shares, strict=True):
            tokens = np.concatenate([found, tail])
            waiting.append(((doc_id.as_py(), tokens), len(tokens), min(max(share.as_py() or 0.0, 0.0), 1.0)))
            if len(waiting) >= WINDOW // 2:
                yield from rows(waiting)
                waiting = []
    yield from rows(waiting, flush=True)


def packed(
    documents: DataFrame,
    tokenizer_path: str,
    loss_share: Column | None = None,
    length: int = LENGTH,
    segments: int = SEGMENTS,
    loss: int = LOSS,
    end: int = END,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset): a row
    for each piece of each row of ``documents``.

    Ids are those of the tokenizer file, then ``end``; a null or empty text has
    ``end`` alone, a long one as many pieces as it needs.  ``loss_share`` (0 to
    1, null: 0) is the share of an example's tokens that bear loss, 1 unless
    given; a piece counts its share, rounded up.  Pieces of a sequence are gapless from offset 0 and keep all
    three limits.  Rows that repeat a key, or have none, are packed each by
    itself; of equal scores the piece that came first goes in; other columns
    are ignored; an empty table gives no rows.
    """
    share = F.lit(1.0) if loss_share is None else loss_share.cast("double")
    rows = bounded_batches(documents).select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"), share.alias("share"))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return rows.mapInArrow(lambda batches: _pieces(batches, tokenizer_path, (length, segments, loss), end), schema)


def share_after_prompt(text: Column) -> Column:
    """The share of a text's characters after its first line, which is its prompt.

    1 for a text of one line, which has no prompt; 0 for a null or empty one.
    """
    first = F.length(F.substring_index(text, "\n", 1))
    whole = F.length(text)
    return F.when(whole > 0, F.when(first < whole, 1 - first / whole).otherwise(1.0)).otherwise(0.0)


def conversation_examples(conversations: DataFrame) -> DataFrame:
    """(doc_id, text, loss_share) of each conversation: its turns in order, one
    line each; the share of its characters that the assistant wrote.

    Turns with a null text are empty; a null conversation id is one of its own.
    """
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = conversations.groupBy(F.col("conv_id").alias("doc_id")).agg(F.sort_array(F.collect_list(turn)).alias("t"))
    size = lambda rows: F.aggregate(rows, F.lit(0).cast("long"), lambda n, r: n + F.length(r["text"]) + 1)
    own = F.filter("t", lambda r: r["role"] == "assistant")
    return turns.select("doc_id", F.array_join(F.transform("t", lambda r: r["text"]), "\n").alias("text"), (size(own) / size(F.col("t"))).alias("loss_share"))
