"""SentencePiece encoding and decoding by a relational lattice and a Viterbi fold."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property
from itertools import batched, chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmaq.llm.common import arrow_map, stored, table
from tarmaq.llm.piece_trie import PieceTrie

#: Words at least this share of all words go into the broadcast dictionary, so it has at most as
#: many entries as this number, whatever the corpus.
DICTIONARY_ENTRIES = 1 << 20
#: Longer words are left to the fold in the task.
DICTIONARY_WORD_CHARS = 48
#: Words that a worker remembers besides the dictionary, before it forgets them all.
REMEMBERED_WORDS = 1 << 18
#: The score of an unknown character, below the least score of a piece, as in the public library.
UNKNOWN_PENALTY = 10.0
#: Kinds of characters between which a text may be parted, the usual ones first, as they are tried
#: in this order: spaces, letters and digits, other signs, line feeds, underscores.
_KINDS = (" ", r"[^\W_]", r"[^\w \n]", r"\n", "_")
#: Words that are counted or looked up together, and the characters of a text that holds as many.
WORDS_AT_ONCE = 1 << 18
LONG_TEXT = 1 << 20


def word_pattern(pieces: Iterable[str]) -> re.Pattern[str]:
    """Finds the words that no piece reaches over, derived from the pieces themselves.

    A text is parted between two kinds of characters only if no piece holds such a pair, so the
    best segmentations of the words, joined, are the best one of the whole text. Most words end
    before a kind that none goes on with, such as a space: one look ahead tells that, before
    the kinds behind are looked at one by one.
    """
    single = [re.compile(k) for k in _KINDS]

    def kind(c: str) -> int:
        return next(i for i, k in enumerate(single) if k.fullmatch(c))

    crossed = {(kind(a), kind(b)) for p in pieces for a, b in zip(p, p[1:], strict=False)}
    runs = [f"{k}++" if (i, i) in crossed else k for i, k in enumerate(_KINDS)]
    more, never = [], []
    for i, run in enumerate(runs):
        before = "|".join(k for j, k in enumerate(_KINDS) if j != i and (j, i) in crossed)
        if before:
            more.append(f"(?<={before}){run}")
        else:
            never.append(_KINDS[i])
    plain = "".join(k for k in never if k[0] != "[")
    ends = "|".join([f"[{plain}]"] * bool(plain) + [k for k in never if k[0] == "["])
    guard = f"(?!{ends})" if ends else ""
    return re.compile(f"(?:{'|'.join(runs)})" + (
        f"(?:{guard}(?:{'|'.join(more)}))*+" if more else ""))


@dataclass(frozen=True)
class Pieces:
    """A piece table: texts with a plain space for the word mark, their ids and scores."""

    ids: dict[str, int]
    scores: dict[str, float]
    byte_ids: tuple[int, ...]
    texts: dict[int, bytes] = field(repr=False)
    longest: int
    unknown: float
    #: Finds the words of a text: see :func:`word_pattern`.
    words: re.Pattern[str]

    @classmethod
    def of(cls, entries: Iterable[tuple[int, str, float]], byte_ids: Iterable[int]) -> Pieces:
        """``entries`` are ``id, piece, score`` with U+2581 for a space, without special ones."""
        kept = [(i, p.replace("▁", " "), s) for i, p, s in entries]
        byte_ids = tuple(byte_ids)
        texts = {i: p.encode() for i, p, _ in kept} | {
            i: bytes([b]) for b, i in enumerate(byte_ids)}
        return cls({p: i for i, p, _ in kept}, {p: s for _, p, s in kept}, byte_ids, texts,
                   max((len(p) for _, p, _ in kept), default=1),
                   min((s for _, _, s in kept), default=0.0) - UNKNOWN_PENALTY,
                   word_pattern(p for _, p, _ in kept))

    @classmethod
    def from_model(cls, path: str) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [i for i in range(model.vocab_size())
                 if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        return cls.of([(i, model.id_to_piece(i), model.get_score(i)) for i in plain],
                      [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)])

    def spell(self, character: str) -> list[int]:
        return [self.byte_ids[b] for b in character.encode()]

    @cached_property
    def trie(self) -> PieceTrie:
        return PieceTrie(self.ids, self.scores, self.unknown)

    def fold(self, word: str) -> list[int]:
        """The best segmentation of one word; of equal scores, the shortest last pieces."""
        best, back, get = [0.0], [0], self.scores.get
        for end in range(1, len(word) + 1):
            top, where = best[end - 1] + get(word[end - 1 : end], self.unknown), end - 1
            for start in range(end - 2, max(0, end - self.longest) - 1, -1):
                score = get(word[start:end])
                if score is not None and best[start] + score > top:
                    top, where = best[start] + score, start
            best.append(top)
            back.append(where)
        out, end = [], len(word)
        while end:
            piece = word[back[end] : end]
            out.append([self.ids[piece]] if piece in self.ids else self.spell(piece))
            end = back[end]
        return [i for part in reversed(out) for i in part]

    def fold_all(self, words: list[str], longest: int) -> Iterator[bytes]:
        """:meth:`fold` of each word as 32-bit numbers; up to ``longest`` characters together."""
        together = iter(self.trie.segment([w for w in words if len(w) <= longest]))
        for word in words:
            ids = next(together) if len(word) <= longest else None
            yield np.array(self.fold(word), np.int32).tobytes() if ids is None else ids


def units(text: str | None, words: re.Pattern[str] | None = None) -> list[str]:
    """The words of a text that a pattern finds; without one the whole text is one.

    Their texts joined are the text after one leading space; an empty text has none.
    """
    if not text:
        return []
    return words.findall(" " + text) if words else [" " + text]


def word_groups(texts: pa.Array, words: re.Pattern[str]
                ) -> Iterator[list[tuple[int, Iterable[str]]]]:
    """The words of the texts in order, as lists of ``place, words`` of bounded size.

    A long text comes in several parts, so that its words are never objects all at once.
    """
    group, held = [], 0
    for place, scalar in enumerate(texts):
        text = scalar.as_py()
        parts = [units(text, words)] if len(text or "") <= LONG_TEXT else batched(
            (m[0] for m in words.finditer(" " + text)), WORDS_AT_ONCE)
        for part in parts:
            group.append((place, part))
            held += len(part)
            if held >= WORDS_AT_ONCE:
                yield group
                group, held = [], 0
    if held:
        yield group


def word_counts(documents: DataFrame, pieces: Pieces, text_column: str = "text",
                longest: int = DICTIONARY_WORD_CHARS) -> DataFrame:
    """``word, count`` over all whole texts, for words of at most ``longest`` characters.

    Counted by Spark alone. Its regular expressions see some rare signs as another kind of
    character; a word that is parted otherwise here is none of the dictionary, and folded later.
    """
    text = F.col(f"`{text_column}`")
    words = documents.where(F.length(text) > 0).select(F.explode(F.regexp_extract_all(
        F.concat(F.lit(" "), text), F.lit(pieces.words.pattern), F.lit(0))).alias("word"))
    return words.where(F.length("word") <= longest).groupBy("word").count()


def lattice(words: DataFrame, pieces: Pieces) -> DataFrame:
    """``word, edges``: every substring of a word that is a piece, grouped by word.

    Substrings of bounded length are exploded and meet the piece table in an equi-join; the table
    is broadcast, as a model fixes its size. A single character without a piece gets an edge of
    its own with id -1.
    """
    spark = words.sparkSession
    known = F.broadcast(spark.createDataFrame(
        [(p, i, pieces.scores[p]) for p, i in pieces.ids.items()],
        "piece string, id int, score double"))
    starts = words.select("word", F.explode(F.sequence(F.lit(0), F.length("word") - 1))
                          .alias("start"))
    parts = starts.select("word", "start", F.explode(F.sequence(F.lit(1), F.least(
        F.lit(pieces.longest), F.length("word") - F.col("start")))).alias("chars"))
    parts = parts.withColumn("piece", F.substring("word", F.col("start") + 1, F.col("chars")))
    edges = parts.join(known, "piece", "left").where("id IS NOT NULL OR chars = 1")
    return edges.groupBy("word").agg(F.collect_list(F.struct(
        (F.col("start") + F.col("chars")).alias("end"), "start",
        F.coalesce("score", F.lit(pieces.unknown)).alias("score"),
        F.coalesce("id", F.lit(-1)).alias("id"))).alias("edges"))


def viterbi(edges: str = "edges", word: str = "word") -> Column:
    """The best path as ``array<struct<start, id>>``: a fold over ends, then one back to 0."""
    state = "array<struct<score:double,start:int,id:int>>"
    first = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("start"),
                             F.lit(0).alias("id"))).cast(state)

    def arrive(best: Column, end: Column) -> Column:
        arriving = F.filter(edges, lambda e: e["end"] == end)
        return F.concat(best, F.array(F.array_max(F.transform(arriving, lambda e: F.struct(
            (F.get(best, e["start"])["score"] + e["score"]).alias("score"),
            e["start"].alias("start"), e["id"].alias("id"))))).cast(state))

    ends = F.sequence(F.lit(1), F.length(word))
    best = F.aggregate(ends, first, arrive)

    def leave(table: Column) -> Column:
        start = F.struct(F.length(word).alias("at"), F.array().cast("array<struct<start:int,id:int>>")
                         .alias("path"))

        def step(state: Column, _: Column) -> Column:
            here = F.get(table, state["at"])
            return F.when(state["at"] == 0, state).otherwise(F.struct(
                here["start"].alias("at"),
                F.concat(F.array(F.struct(here["start"].alias("start"), here["id"].alias("id"))),
                         state["path"]).alias("path")))

        return F.aggregate(ends, start, step, lambda state: state["path"])

    return F.element_at(F.transform(F.array(best), leave), 1)


def dictionary(counts: DataFrame, pieces: Pieces, entries: int = DICTIONARY_ENTRIES,
               longest: int = DICTIONARY_WORD_CHARS) -> dict[str, bytes]:
    """The frequent words with their ids as 32-bit numbers; ``entries`` at the very most."""
    counts = stored(counts, "words")
    total = counts.agg(F.sum("count")).first()[0] or 0
    frequent = counts.where((F.col("count") >= max(1, total / entries))
                            & (F.length("word") <= longest)).select("word")
    paths = lattice(frequent, pieces).select("word", viterbi().alias("path"))
    out = {}
    for word, path in paths.toLocalIterator():
        ids = [i for at, i in path for i in ([i] if i >= 0 else pieces.spell(word[at]))]
        out[word] = np.array(ids, np.int32).tobytes()
    return out


def _joined(index: np.ndarray, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of ``parts[i]`` for each ``i`` of ``index`` in a row, and where each one ends."""
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
    sizes, starts = sizes[index], (np.cumsum(sizes) - sizes)[index]
    ends = np.cumsum(sizes)
    places = np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1])
    return np.frombuffer(b"".join(parts), np.int32)[places], ends


def encode(documents: DataFrame, pieces: Pieces, text_column: str = "text",
           ids_column: str = "ids", entries: int = DICTIONARY_ENTRIES,
           longest: int = DICTIONARY_WORD_CHARS, keep_text: bool = True) -> DataFrame:
    """``documents`` with ``ids``: each text's pieces of the highest summed score.

    Words are encoded once, not per document: the frequent ones by the relational lattice, as a
    dictionary of bounded size; any other word by the same fold when a task meets it. Nothing is
    shuffled but word counts. Null texts stay null, an empty text has no ids, a column that is
    already called ``ids_column`` is replaced, and rows may repeat. Without ``keep_text`` the texts
    need not travel back from the Python workers.
    """
    spark = documents.sparkSession
    known = spark.sparkContext.broadcast(
        (pieces, dictionary(word_counts(documents, pieces, text_column, longest), pieces, entries,
                            longest)))
    others = [c for c in documents.columns if c != ids_column]
    rows_in = documents.select(*[F.col(f"`{c}`") for c in others])
    kept = [c for c in others if keep_text or c != text_column]
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows_in.schema
                     if f.name in kept)
    rare: dict[str, bytes] = {}

    def rows(batch: pa.RecordBatch):
        pieces, frequent = known.value

        texts, parts = batch[text_column], [np.zeros(0, np.int32)]
        sizes = np.zeros(len(texts) + 1, np.int64)
        for group in word_groups(texts, pieces.words):
            place: defaultdict[str, int] = defaultdict(count().__next__)
            index = np.fromiter(map(place.__getitem__, chain.from_iterable(
                words for _, words in group)), np.int64)
            new = [w for w in place if w not in frequent and w not in rare]
            if len(rare) + len(new) > REMEMBERED_WORDS:
                rare.clear()
                new = [w for w in place if w not in frequent]
            here = dict(zip(new, pieces.fold_all(new, longest), strict=True))
            rare.update((w, ids) for w, ids in here.items() if len(w) <= longest)
            ids, ends = _joined(index, [
                frequent.get(w) or rare.get(w) or here[w] for w in place])
            parts.append(ids)
            places, counts = zip(*((p, len(w)) for p, w in group), strict=True)
            ends = np.concatenate([[0], ends])[np.cumsum((0, *counts))]
            np.add.at(sizes, np.array(places) + 1, np.diff(ends))
        offsets = pa.array(np.cumsum(sizes).astype(np.int32))
        ids = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(parts)),
                                       mask=texts.is_null())
        yield {c: batch[c] for c in kept} | {ids_column: ids}

    return arrow_map(rows_in, rows, f"{fields}`{ids_column}` array<int>")


def spelled(ids: Column, pieces: Pieces) -> Column:
    """The text that ids spell, in built-in expressions; null for null.

    The pieces stand in one constant array by id, as hexadecimal bytes, since a piece of a byte is
    no text by itself; the model fixes its size. The first byte is the space before each text.
    """
    table = F.split(F.lit(",".join(
        pieces.texts.get(i, b"").hex() for i in range(max(pieces.texts) + 1))), ",")
    joined = F.unhex(F.array_join(F.transform(ids, lambda i: F.get(table, i)), ""))
    return F.decode(F.substring(joined, 2, 0x7FFFFFFF), "UTF-8")


def decode(encoded: DataFrame, pieces: Pieces, ids_column: str = "ids",
           text_column: str = "decoded") -> DataFrame:
    """``encoded`` with the texts that the ids spell; null ids stay null."""
    return encoded.withColumn(text_column, spelled(F.col(f"`{ids_column}`"), pieces))


def default_model() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


def op9_sentence_pieces(spark: SparkSession, folder: str, model: str | None = None) -> DataFrame:
    """Ids of every document, and the digest of what they decode to."""
    pieces = Pieces.from_model(model or default_model())
    documents = table(spark, folder, "documents").select(
        "doc_id", "text", F.sha2(F.encode("text", "UTF-8"), 256).alias("text_sha256"))
    return decode(encode(documents, pieces, keep_text=False), pieces).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", "text_sha256",
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))
