"""Best-fit decreasing packing of documents into token sequences.

1. Documents are tokenised and cut where they lie; only the pieces' lengths and positions go on.
2. How a piece is packed depends on its length alone, and there are no more lengths than tokens in a sequence.
   So the driver packs the histogram of lengths: best-fit decreasing over all pieces, exactly as one by one,
   but pieces of equal length and bins of equal room are moved together. The tightest room that still
   fits is found in a segment tree over capacities, in logarithmic time.
3. The plan says which ranks of each length go to which bins. Pieces are ranked within their length (counts per
   written file, then running sums), and joined to the plan by length and rank.

Work on the driver depends on the sequence length only, not on the number of documents.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citylake.llm.common import ship, staged, text_of

SEQUENCE_TOKENS = 2048
END_ID = 0
# Texts are tokenised in blocks of about so many bytes, which bounds a worker's memory.
BLOCK_BYTES = 16 * 1024 * 1024
# Distinct words are handed to the tokenizer joined, about so many at a time.
WORDS_AT_ONCE = 2000
# The plan is broadcast up to so many rows (40 bytes each), else joined by a shuffle. It has a few thousand.
PLAN_BROADCAST_ROWS = 500_000

PIECE_SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, nth bigint"

ship(__name__)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class WordEncoder:
    """Token ids of many texts at once, equal to those of encoding each text by itself.

    A token never spans the place before a space that a visible character follows: white space before it is split
    off, and the space goes with the word. So a text's ids are those of its words, each with the space before
    it, and every distinct word of a block of texts is encoded once. Texts with a space that is followed by white
    space or by nothing are encoded whole, and so are those with the literal of an added token (as <|endoftext|>),
    which the tokenizer takes out before it looks at words.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import numpy as np
        from tokenizers import Tokenizer

        self.np = np
        self.tokenizer = Tokenizer.from_file(path)
        added = {number: token.content for number, token in self.tokenizer.get_added_tokens_decoder().items()}
        self.literals = [content for content in added.values() if content]
        vocabulary = self.tokenizer.get_vocab()
        # A byte-level token is spelled with one character for each byte it stands for.
        self.token_bytes = np.zeros(max(vocabulary.values()) + 1, "i4")
        for token, number in vocabulary.items():
            self.token_bytes[number] = len(added[number].encode()) if number in added else len(token)

    def _encode(self, texts: list[str]) -> list:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [self.np.array(x.ids, "u4") for x in found]

    def _spaced_words(self, words) -> tuple:
        """Flat ids and their offsets for words that each follow a space, encoded in joined groups."""
        import pyarrow.compute as pc

        np, found = self.np, [self.np.zeros(0, "u4")]
        for i in range(0, len(words), WORDS_AT_ONCE):
            joined = " " + " ".join(group := words.slice(i, WORDS_AT_ONCE).to_pylist())
            # Words of different texts may spell a literal that has a space in it.
            mixed = any(x in joined for x in self.literals)
            found += self._encode([" " + w for w in group] if mixed else [joined])
        flat = np.concatenate(found)
        ends = np.cumsum(self.token_bytes[flat])
        word_ends = np.cumsum(pc.binary_length(words).to_numpy() + 1)
        return flat, np.r_[0, np.searchsorted(ends, word_ends) + 1]

    def encode(self, texts) -> list:
        """Id arrays of an Arrow array of non-null texts."""
        import pyarrow as pa
        import pyarrow.compute as pc

        np = self.np
        pieces = pc.split_pattern(texts, " ")
        offsets, words = pieces.offsets.to_numpy(), pieces.flatten()
        offsets = offsets - offsets[0]
        coded = words.dictionary_encode()
        odd_word = pc.match_substring_regex(coded.dictionary, r"^([\s\p{Z}\x0b\x1c-\x1f\x85]|$)")
        odd_word = odd_word.to_numpy(zero_copy_only=False)
        codes = coded.indices.to_numpy()
        odd = np.add.reduceat(np.r_[odd_word[codes], False].astype("i4"), offsets[:-1]) > 0 if len(texts) else np.zeros(0, bool)
        for literal in self.literals:
            odd |= pc.match_substring(texts, literal).to_numpy(zero_copy_only=False)
        used = np.zeros(len(odd_word), bool)
        inner = np.repeat(~odd, np.diff(offsets))
        inner[offsets[:-1]] = False  # first words follow no space
        used[codes[inner]] = True
        place = np.cumsum(used) - 1
        flat, at = self._spaced_words(coded.dictionary.filter(pa.array(used)))
        alone = [texts[i].as_py() if odd[i] else words[int(offsets[i])].as_py() for i in range(len(texts))]
        result = self._encode(alone)
        for i, head in enumerate(result):
            if not odd[i] and offsets[i + 1] - offsets[i] > 1:
                word = place[codes[offsets[i] + 1 : offsets[i + 1]]]
                first, count = at[word], at[word + 1] - at[word]
                ends = np.cumsum(count)
                where = np.arange(ends[-1]) + np.repeat(first - ends + count, count)
                result[i] = np.concatenate([head, flat[where]])
        return result


def cut(n_tokens: int, room: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document; only the first may be shorter than ``room``."""
    head = n_tokens % room or room
    return [(0, min(head, n_tokens))] + [(s, room) for s in range(head, n_tokens, room)]


def _pieces(path: str, room: int, end_id: int):
    def blocks(batch) -> Iterator:
        """Slices of a record batch of bounded bytes; a longer text is a slice of its own."""
        import numpy as np
        import pyarrow.compute as pc

        sizes = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
        start = held = 0
        for i, size in enumerate(np.asarray(sizes)):
            if held and held + size > BLOCK_BYTES:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)

    def run(batches: Iterator) -> Iterator:
        import zlib

        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        encoder, part = WordEncoder(path), TaskContext.get().partitionId()
        seen = np.zeros(room + 1, "i8")  # pieces of each length so far in this task
        for batch in (b for whole in batches for b in blocks(whole)):
            rows = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(batch.column("text"))):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for k, (start, length) in enumerate(cut(len(ids), room)):
                    crc = zlib.crc32(ids[start : start + length].tobytes())
                    rows.append((doc_id, k, start, length, crc, part, int(seen[length])))
                    seen[length] += 1
            columns = list(zip(*rows))
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)
            pa.default_memory_pool().release_unused()  # the worker lives on, beside those of other tasks

    return run


class RoomTree:
    """Segment tree over capacities: the number of open bins with each remaining room."""

    def __init__(self, room: int):
        self.size = 1 << room.bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, room: int, n: int) -> None:
        node = room + self.size
        while node:
            self.count[node] += n
            node >>= 1

    def tightest(self, length: int) -> int | None:
        """Smallest room of at least ``length`` that an open bin has."""
        node = length + self.size
        if self.count[node]:
            return length
        while node > 1:
            if not node & 1 and self.count[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if self.count[2 * node] else 2 * node + 1
                return node - self.size
            node >>= 1
        return None


def plan_bins(histogram: dict[int, int], room: int = SEQUENCE_TOKENS) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing of ``histogram[length]`` pieces of each length.

    Runs ``(length, first rank, end rank, first bin, pieces per bin, offset)``: the piece of rank r goes to
    bin ``first bin + (r - first rank) // per bin``. One by one, a piece goes to the tightest bin and makes it
    tighter still, so the next equal piece follows it for as long as it fits; hence a bin takes all it
    can of one length at once, and equal bins in turn.
    """
    tree, bins_of = RoomTree(room), {}  # remaining room -> intervals of bin numbers
    runs, n_bins = [], 0

    def leave(left: int, first: int, n: int) -> None:
        if left and n:
            bins_of.setdefault(left, []).append((first, n))
            tree.add(left, n)

    for length in sorted((x for x in histogram if histogram[x]), reverse=True):
        rank, total = 0, histogram[length]

        def fill(left: int, first: int, n: int) -> None:
            """Put what is still to place into up to ``n`` equal bins with ``left`` tokens of room."""
            nonlocal rank
            per = left // length
            full = min(n, (total - rank) // per)
            if full:
                runs.append((length, rank, rank + full * per, first, per, room - left))
                rank += full * per
                leave(left - per * length, first, full)
            rest = total - rank if full < n else 0
            if rest:
                runs.append((length, rank, total, first + full, rest, room - left))
                rank = total
                leave(left - rest * length, first + full, 1)
                full += 1
            leave(left, first + full, n - full)

        while rank < total and (left := tree.tightest(length)) is not None:
            first, n = bins_of[left].pop()
            tree.add(left, -n)
            fill(left, first, n)
        if rank < total:
            new = -(-(total - rank) // (room // length))
            first, n_bins = n_bins, n_bins + new
            fill(room, first, new)
    return runs


def pack(docs: DataFrame, room: int = SEQUENCE_TOKENS, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Pack all documents into sequences of at most ``room`` tokens; one row per piece.

    Null and empty texts are a document of the end token alone. Only longer documents than ``room`` are cut. A
    null ``doc_id`` stays null; rows that repeat a ``doc_id`` are packed each. Columns other than ``doc_id`` and
    ``text`` are not read. No documents give no rows. ``path`` names the tokenizer's vocabulary file.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint"), text_of().alias("text"))
    run = _pieces(path or tokenizer_path(), room, end_id)
    pieces = staged(rows.mapInArrow(run, PIECE_SCHEMA), "pieces")

    counts = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    # At most one row per length, and there are `room` lengths.
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = plan_bins(histogram, room)
    plan = spark.createDataFrame(runs, "length bigint, low bigint, high bigint, bin bigint, per bigint, at bigint")
    if len(runs) <= PLAN_BROADCAST_ROWS:
        plan = F.broadcast(plan)
    # A third of all pieces may have one length; the join is a broadcast or a skew join, never one task.
    ranked = pieces.join(bases, ["length", "part"]).withColumn("rank", F.col("base") + F.col("nth"))
    place = (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    nth = F.col("rank") - F.col("low")
    return (
        ranked.join(plan.withColumnRenamed("length", "of"), (F.col("length") == F.col("of")) & place)
        .select(
            "doc_id",
            "piece",
            "start",
            "length",
            "ids_crc32",
            (F.col("bin") + F.expr("(rank - low) div per")).alias("sequence_id"),
            (F.col("at") + nth % F.col("per") * F.col("length")).alias("offset"),
        )
    )
