"""Retrieval packing: documents that share words fill a window together.

Whole windows of a long document are sequences of their own. What is left of
every document (its tail) is packed: tails are dealt out by a sketch of their
tokens, so that like texts meet in one shard of at most ``SHARD_DOCS`` tails.
A shard builds a BM25 inverted index over its token ids, with document
frequencies of the whole corpus. The longest unused tail seeds a window; the
index returns unused neighbours, which fill the window greedily; the best
neighbour that is too long is cut and seeds the next window with its rest. If all
that the index returned have fitted, it is asked for all others. What a
shard cannot fill goes on to the next one; the last rest of a partition becomes
sequences whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millpulse.llm.common import stored, table

WINDOW = 2048
END_ID = 1
SHARD_DOCS = 2048
QUERY_TERMS = 24
#: Neighbours that the index returns at first.
NEIGHBOURS = 64
#: Signs of random projections of all tokens. Of six keys tried on 9,295 tails this
#: one had the most of the ten best neighbours in the seed's own shard.
SKETCH_BITS = 16
K1, B = 1.2, 0.75
#: Words and pieces a process keeps, about 200 bytes each.
CACHED_WORDS = 1_000_000
#: Added to the sequence ids of whole windows.
WHOLE = 1 << 60
#: Words in lower case whose pieces are plain: an apostrophe may begin an ending.
_VISIBLE = re.compile(rb"[!-&(-@\[-~]+")
_PIECES = re.compile(rb"[a-z]+|[0-9]|[^a-z0-9]+")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class KnownWords(dict):
    """Token ids of words as bytes, found when they are first asked for. Two
    generations: when the young one is full it becomes the old one, and words met
    again move up, so frequent words stay."""

    def __init__(self, find, most: int):
        super().__init__()
        self.find, self.most, self.old = find, max(1, most // 2), {}

    def __missing__(self, word: bytes) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self.find(word)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[word] = ids
        return ids


class WordEncoder:
    """Token ids of texts. The tokenizer drops white space and never joins over
    it, so words are encoded once and their ids kept, up to a bound.

    It lowers case itself, and takes runs of letters, single digits and runs of
    other signs apart. Words of visible ASCII are cut the same way here, so that few
    pieces are new. A word of letters in lower case and composed form is a unit of
    the model: no normalizer and no pattern have to look at it. A text that may hold
    special tokens, which are found before case is lowered, is left as it is.
    """

    def __init__(self, path: str, cached: int = CACHED_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.known = KnownWords(self._find, cached)
        self.model = Tokenizer.from_file(path).model
        # The byte-level step spells a byte as the Latin-1 character if that can be
        # seen, else as the next character from U+0100 on.
        seen = {*range(33, 127), *range(161, 173), *range(174, 256)}
        self.spelling = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in seen)}
        self.bytes_of = [int(i).to_bytes(4, "little") for i in range(self.vocabulary)]

    @property
    def vocabulary(self) -> int:
        return self.tokenizer.get_vocab_size(with_added_tokens=True)

    def _slow(self, text: str) -> bytes:
        ids = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(ids, dtype="<u4").tobytes()

    def _find(self, word: bytes) -> bytes:
        if word.isalpha() and word.islower():  # letters of ASCII
            return b"".join([self.bytes_of[token.id] for token in self.model.tokenize(word.decode())])
        if word[-1:] in (b",", b".") and word[:-1].isalpha() and word[:-1].islower():
            return self.known[word[:-1]] + self.known[word[-1:]]
        if _VISIBLE.fullmatch(word) and b"<|" not in word:
            pieces = _PIECES.findall(word)
            if len(pieces) > 1:
                return b"".join(map(self.known.__getitem__, pieces))
            return b"".join([self.bytes_of[token.id] for token in self.model.tokenize(word.decode())])
        text = word.decode("utf-8", "surrogatepass")
        lower = text.lower()
        # the sigma at the end of a word has a form of its own, which the tokenizer does not use
        if lower.isalpha() and "\u03a3" not in text and unicodedata.is_normalized("NFC", text):
            spelled = lower.encode().decode("latin-1").translate(self.spelling)
            return b"".join([self.bytes_of[token.id] for token in self.model.tokenize(spelled)])
        if len(text) > 1 and text[-1] in ".," and text[-2].isalpha() and b"<|" not in word:
            return self.known[word[:-1]] + self.known[word[-1:]]
        return self._slow(text)

    def encode(self, texts: list[str | None], end_id: int | None = END_ID) -> Iterator[np.ndarray]:
        end = b"" if end_id is None else np.array([end_id], dtype="<u4").tobytes()
        ids_of = self.known.__getitem__
        for text in texts:
            whole = (text or "").encode("utf-8", "surrogatepass")
            words = (whole if b"<|" in whole else whole.lower()).split()
            yield np.frombuffer(b"".join(map(ids_of, words)) + end, dtype="<u4")


_encoders: dict[tuple[str, int], WordEncoder] = {}


def shared_encoder(path: str, cached: int = CACHED_WORDS) -> WordEncoder:
    """One for each worker process: its words serve the tasks that follow."""
    if (path, cached) not in _encoders:
        _encoders[path, cached] = WordEncoder(path, cached)
    return _encoders[path, cached]


def _planes(vocabulary: int) -> np.ndarray:
    return np.random.default_rng(7).standard_normal((vocabulary, SKETCH_BITS)).astype(np.float32)


def _pieces(path: str, window: int, end_id: int, cached: int):
    """Whole windows and tails of each document; 16 bits hold an id of this
    vocabulary, a larger one takes 32."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = shared_encoder(path, cached)
        kind = "<u2" if encoder.vocabulary <= 1 << 16 else "<u4"
        planes = _planes(max(encoder.vocabulary, end_id + 1))
        powers = 1 << np.arange(SKETCH_BITS)
        for batch in batches:
            for k in range(0, len(batch), 256):
                part = batch.iloc[k : k + 256]
                out = []
                for doc_id, ids in zip(part["doc_id"], encoder.encode(list(part["text"]), end_id)):
                    n = len(ids)
                    for start in range(0, n - window + 1, window):
                        out.append((doc_id, start, n, True, 0, ids[start : start + window].astype(kind).tobytes()))
                    if n % window:
                        tail = ids[n - n % window :]
                        side = planes[tail].sum(axis=0) > 0
                        out.append((doc_id, n - n % window, n, False, int(side @ powers), tail.astype(kind).tobytes()))
                yield pd.DataFrame(out, columns=["doc_id", "start", "doc_tokens", "whole", "sketch", "ids"])

    return run


def term_counts(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids, ascending, and how often each is there; not for no ids. The
    stable order of 16-bit numbers is a radix sort."""
    own = np.sort(ids, kind="stable")
    first = np.ones(len(own), dtype=bool)
    np.not_equal(own[1:], own[:-1], out=first[1:])
    at = np.flatnonzero(first)
    count = np.empty_like(at)
    count[:-1] = at[1:] - at[:-1]
    count[-1] = len(own) - at[-1]
    return own[at], count


def _frequencies(kind: str, size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for ids in batch["ids"]:
                counts[term_counts(np.frombuffer(ids, dtype=kind))[0]] += 1
        term = np.flatnonzero(counts)
        yield pd.DataFrame({"term": term, "docs": counts[term]})

    return run


class Shard:
    """BM25 inverted index over tails (token id arrays)."""

    def __init__(self, tails: list[np.ndarray], idf: np.ndarray, mean_length: float):
        self.n = len(tails)
        terms, tfs, sizes = [], [], []
        for ids in tails:
            t, c = term_counts(ids)
            terms.append(t)
            tfs.append(c)
            sizes.append(len(t))
        self.at = np.concatenate([[0], np.cumsum(sizes)])
        term = np.concatenate(terms).astype(np.int64)
        tf = np.concatenate(tfs)
        doc = np.repeat(np.arange(self.n), sizes)
        length = np.array([len(ids) for ids in tails])[doc]
        weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean_length))
        self.term, self.weight = term, weight
        order = np.argsort(term, kind="stable")
        self.doc, self.posted = doc[order], weight[order]
        self.first = np.searchsorted(term[order], np.arange(len(idf) + 1))

    def neighbours(self, seed: int, unused: np.ndarray, most: int | None = None) -> np.ndarray:
        """Unused tails, best BM25 score for the seed's weightiest terms first,
        ``most`` of them; ties and tails that share no term in shard order."""
        own = slice(self.at[seed], self.at[seed + 1])
        term, weight = self.term[own], self.weight[own]
        if len(term) > QUERY_TERMS:
            term = term[np.argpartition(-weight, QUERY_TERMS)[:QUERY_TERMS]]
        ranges = [slice(self.first[t], self.first[t + 1]) for t in term.tolist()]
        docs = np.concatenate([self.doc[r] for r in ranges])
        score = np.bincount(docs, np.concatenate([self.posted[r] for r in ranges]), self.n)
        left = np.flatnonzero(unused)
        score = -score[left]
        if most is not None and most < len(left):
            near = score <= np.partition(score, most - 1)[most - 1]
            left, score = left[near], score[near]
        return left[np.argsort(score, kind="stable")][:most]


def pack_shard(
    tails: list[tuple], idf: np.ndarray, mean_length: float, window: int, final: bool
) -> tuple[list[list[tuple]], list[tuple]]:
    """Full windows, each a list of pieces (doc_id, start, doc_tokens, ids), and
    the tails that filled none (empty if ``final``)."""
    n = len(tails)
    size = np.array([len(t[3]) for t in tails])
    begin = np.zeros(n, dtype=np.int64)
    unused = np.ones(n, dtype=bool)
    left = int(size.sum())
    shard = Shard([t[3] for t in tails], idf, mean_length)
    order = iter(np.argsort(-size, kind="stable").tolist())
    out: list[list[tuple]] = []
    seed = None

    def take(i: int, length: int) -> tuple:
        doc_id, start, doc_tokens, ids = tails[i]
        a = int(begin[i])
        begin[i] += length
        size[i] -= length
        unused[i] = size[i] > 0
        return doc_id, start + a, doc_tokens, ids[a : a + length]

    while left >= window:
        if seed is None or not unused[seed]:
            seed = next(i for i in order if unused[i])
        pieces, room = [take(seed, min(int(size[seed]), window))], window
        room -= len(pieces[0][3])
        first, seed = seed, None
        most = NEIGHBOURS
        while room:
            longer = None
            for i in shard.neighbours(first, unused, most).tolist():
                length = int(size[i])
                if length <= room:
                    pieces.append(take(i, length))
                    room -= length
                    if not room:
                        break
                elif longer is None:
                    longer = i
            if room and longer is not None:
                pieces.append(take(longer, room))
                room, seed = 0, longer
            most = None  # all of these fit: now all others
        left -= window
        out.append(pieces)
    rest = [
        (t[0], t[1] + int(begin[i]), t[2], t[3][int(begin[i]) :])
        for i, t in enumerate(tails) if unused[i]
    ]
    if not final:
        return out, rest
    while left:
        length = 1 << (left.bit_length() - 1)
        left -= length
        pieces = []
        while length:
            doc_id, start, doc_tokens, ids = rest.pop(0)
            part = ids[:length]
            length -= len(part)
            pieces.append((doc_id, start, doc_tokens, part))
            if len(part) < len(ids):
                rest.insert(0, (doc_id, start + len(part), doc_tokens, ids[len(part) :]))
        out.append(pieces)
    return out, []


def _packer(kind: str, idf: np.ndarray, mean_length: float, window: int, shard_docs: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 33

        def rows(full: list[list[tuple]]) -> pd.DataFrame:
            nonlocal number
            out = []
            for pieces in full:
                offset = 0
                for doc_id, start, doc_tokens, ids in pieces:
                    out.append((doc_id, start, len(ids), doc_tokens, number, offset, ids.astype("<u4").tobytes()))
                    offset += len(ids)
                number += 1
            return pd.DataFrame(
                out, columns=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
            )

        held: list[tuple] = []
        for batch in batches:
            for doc_id, start, doc_tokens, ids in zip(
                batch["doc_id"], batch["start"], batch["doc_tokens"], batch["ids"]
            ):
                held.append((doc_id, start, doc_tokens, np.frombuffer(ids, dtype=kind)))
                if len(held) >= shard_docs:
                    full, held = pack_shard(held, idf, mean_length, window, False)
                    yield rows(full)
        if held:
            full, _ = pack_shard(held, idf, mean_length, window, True)
            yield rows(full)

    return run


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
    window: int = WINDOW, end_id: int = END_ID, shard_docs: int = SHARD_DOCS, cached: int = CACHED_WORDS,
) -> DataFrame:
    """(doc_id, start, length, doc_tokens, sequence_id, offset, ids), a row for
    each piece; ids are little-endian unsigned 32-bit numbers.

    Null or empty text is the end id alone. Rows of null or repeated ids are
    packed like others, each on its own. ``window`` must be a power of two. A worker
    process keeps ``cached`` words for the tasks that follow.
    """
    path = path or tokenizer_path()
    encoder = WordEncoder(path)
    size = max(encoder.vocabulary, end_id + 1)
    kind = "<u2" if encoder.vocabulary <= 1 << 16 else "<u4"
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    pieces = stored(
        rows.mapInPandas(
            _pieces(path, window, end_id, cached),
            f"doc_id {id_type}, start long, doc_tokens long, whole boolean, sketch int, ids binary",
        ),
        "token-pieces",
    )
    tails = pieces.where("NOT whole")
    # a row for each id of the vocabulary at most
    found = (
        tails.select("ids").mapInPandas(_frequencies(kind, size), "term long, docs long")
        .groupBy("term").agg(F.sum("docs").alias("docs")).collect()
    )
    n, tokens = tails.agg(F.count("*"), F.sum(F.length("ids"))).first()
    frequency = np.zeros(size)
    for term, count in found:
        frequency[term] = count
    idf = np.log1p((n - frequency + 0.5) / (frequency + 0.5))
    mean_length = max(1.0, (tokens or 0) / max(1, n) / np.dtype(kind).itemsize)
    ids32 = "doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"
    packed = (
        tails.select("doc_id", "start", "doc_tokens", "sketch", "ids")
        .repartitionByRange("sketch", F.xxhash64("doc_id"), "doc_id", "start")
        .sortWithinPartitions("sketch", F.xxhash64("doc_id"), "doc_id", "start", "ids")
        .mapInPandas(
            _packer(kind, idf, mean_length, window, shard_docs),
            f"doc_id {id_type}, start long, length long, doc_tokens long, sequence_id long, "
            "offset long, ids binary",
        )
    )
    whole = (
        pieces.where("whole")
        .withColumn("sequence_id", F.lit(WHOLE) + F.monotonically_increasing_id())
        .mapInPandas(
            _widen(kind),
            f"doc_id {id_type}, start long, length long, doc_tokens long, sequence_id long, "
            "offset long, ids binary",
        )
    )
    return packed.select(*ids32).unionByName(whole)


def _widen(kind: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = [np.frombuffer(i, dtype=kind).astype("<u4") for i in batch["ids"]]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"], "start": batch["start"], "length": [len(i) for i in ids],
                    "doc_tokens": batch["doc_tokens"], "sequence_id": batch["sequence_id"],
                    "offset": 0, "ids": [i.tobytes() for i in ids],
                }
            )

    return run


def digest_columns(packed: DataFrame) -> DataFrame:
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op4_lexical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_columns(pack(table(spark, sf_dir, "documents").select("doc_id", "text")))


QUERIES = {"op4_lexical_packing": op4_lexical_packing}
ORACLE: dict[str, str] = {}
