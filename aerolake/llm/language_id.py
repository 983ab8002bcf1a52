"""Language identification by segmentation-marginalised unigram models.

Every language has a probability for each piece of a fixed public vocabulary.
The probability of a word is the sum, over all its segmentations into pieces,
of the product of the piece probabilities; a forward algorithm over the
characters computes it, for all distinct words of a slice of text at once. A
text's score is the product over its words. The piece probabilities come from
expectation-maximisation on a bounded sample of labelled documents.

Words are the runs of ASCII letters and non-ASCII characters of the
lower-cased text, each preceded by the vocabulary's word-start mark. All pieces
of the vocabulary take part. Runs of more than ``_LONG`` characters are cut into
parts of that size, scored like words: segmentations over such a cut are not
summed (a run may be a whole text in scripts without spaces, and the forward
sums of all of a slice's parts are taken side by side).

Defined cases: a text that is null or has no letter is ``und`` with score 0;
with no labelled document at all, every text is ``und``; documents are judged
row by row, so repeated rows get the same answer; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, bound_batches, held_out, release, sampled, schema, ship

UNDETERMINED = "und"
_START = "▁"  # the vocabulary's mark of a word start
_LONG = 30         # characters of a word scored at once
_UNKNOWN = 1e-7    # probability of a character outside the vocabulary
_LETTERS = bytes(c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))
_P = 0x100000001B3
_TABLE_BITS = 20


def has_letter(text: str) -> bool:
    return next(filter(str.isalpha, text), None) is not None


def words_of(text: str | None) -> list[bytes]:
    return text.lower().encode().translate(_LETTERS).split() if text else []


class Pieces:
    """The vocabulary, found by a hash of a piece's code points."""

    def __init__(self, pieces: list[str]):
        self.pieces = sorted({p for p in pieces if 0 < len(p) <= _LONG})
        self.longest = max(map(len, self.pieces), default=1)
        with np.errstate(over="ignore"):
            self.powers = np.cumprod(np.full(_LONG + 2, _P, np.uint64)) * np.uint64(pow(_P, -1, 1 << 64))
            hashes = np.array([self._hash(p) for p in self.pieces], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], order.astype(np.int32)
        # Direct lookup by the upper bits, then a short walk over equal upper bits.
        self.first = np.searchsorted(self.hashes, np.arange(1 << _TABLE_BITS, dtype=np.uint64)
                                     << np.uint64(64 - _TABLE_BITS)).astype(np.int32)
        ends = np.append(self.first[1:], len(self.hashes))
        self.walk = int((ends - self.first).max())

    @staticmethod
    def _hash(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * _P + ord(c)) & 0xFFFFFFFFFFFFFFFF
        return (h * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece numbers of hashes; the number after the last one if none."""
        h = h * np.uint64(0x9E3779B97F4A7C15)
        at = self.first[(h >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)]
        out = np.full(len(h), len(self.pieces), np.int32)
        for step in range(self.walk):
            slot = np.minimum(at + step, len(self.hashes) - 1)
            hit = self.hashes[slot] == h
            out[hit] = self.ids[slot[hit]]
        return out

    def lattices(self, words: list[str]):
        """Words of one length at a time: (their numbers, {(end, size): piece numbers})."""
        by_length: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by_length.setdefault(len(w), []).append(i)
        for n, numbers in by_length.items():
            codes = np.array([words[i] for i in numbers], dtype=f"<U{n}").view(np.uint32).reshape(-1, n).astype(np.uint64)
            prefix = np.zeros((n + 1, len(numbers)), np.uint64)
            for i in range(n):
                prefix[i + 1] = prefix[i] * np.uint64(_P) + codes[:, i]
            yield np.array(numbers), n, {
                (end, size): self.find(prefix[end] - prefix[end - size] * self.powers[size])
                for end in range(1, n + 1) for size in range(1, min(end, self.longest) + 1)}

    def padded(self, probs: np.ndarray) -> np.ndarray:
        """(pieces + 1, languages): a last row for what is no piece."""
        return np.vstack([probs, np.zeros((1, probs.shape[1]))])


def _step(table: np.ndarray, found: np.ndarray, size: int, none: int) -> np.ndarray:
    p = table[found]
    if size == 1:  # a character outside the vocabulary still has a path
        p = np.where((found == none)[:, None], _UNKNOWN, p)
    return p


def word_scores(vocab: Pieces, probs: np.ndarray, words: list[str]) -> np.ndarray:
    """log P(word | language), (words, languages), over all segmentations."""
    table, none = vocab.padded(probs), len(vocab.pieces)
    out = np.zeros((len(words), probs.shape[1]))
    with np.errstate(over="ignore"):
        for numbers, n, lattice in vocab.lattices(words):
            forward = np.zeros((n + 1, len(numbers), probs.shape[1]))
            forward[0] = 1.0
            for end in range(1, n + 1):
                for size in range(1, min(end, vocab.longest) + 1):
                    forward[end] += forward[end - size] * _step(table, lattice[end, size], size, none)
            out[numbers] = np.log(np.maximum(forward[n], 1e-300))
    return out


def expected_counts(vocab: Pieces, probs: np.ndarray, words: list[str], weights: np.ndarray) -> np.ndarray:
    """Expected uses of each piece in the words, for one language's probabilities."""
    table, none = vocab.padded(probs), len(vocab.pieces)
    counts = np.zeros(none + 1)
    with np.errstate(over="ignore"):
        for numbers, n, lattice in vocab.lattices(words):
            p = {k: _step(table, f, k[1], none)[:, 0] for k, f in lattice.items()}
            forward, backward = np.zeros((n + 1, len(numbers))), np.zeros((n + 1, len(numbers)))
            forward[0] = backward[n] = 1.0
            for end in range(1, n + 1):
                for size in range(1, min(end, vocab.longest) + 1):
                    forward[end] += forward[end - size] * p[end, size]
            for end in range(n, 0, -1):
                for size in range(1, min(end, vocab.longest) + 1):
                    backward[end - size] += backward[end] * p[end, size]
            share = weights[numbers] / np.maximum(forward[n], 1e-300)
            for (end, size), found in lattice.items():
                counts += np.bincount(found, forward[end - size] * p[end, size] * backward[end] * share,
                                      minlength=none + 1)
    return counts[:none]


def pieced(word: bytes) -> list[str]:
    """A word as the strings that are scored: marked, cut every ``_LONG``."""
    marked = _START + word.decode("utf-8", "ignore")
    return [marked[i:i + _LONG] for i in range(0, len(marked), _LONG)]


class Model:
    def __init__(self, vocab: Pieces, langs: list[str], priors: np.ndarray, probs: np.ndarray):
        self.vocab, self.langs, self.priors, self.probs = vocab, langs, priors, probs

    @classmethod
    def fit(cls, pieces: list[str], counts: list[tuple[str, bytes, int]], docs: dict[str, int],
            rounds: int = 3, smoothing: float = 0.05) -> Model:
        vocab, langs = Pieces(pieces), sorted(docs)
        probs = np.zeros((len(vocab.pieces), len(langs)))
        for k, lang in enumerate(langs):
            bag: Counter[str] = Counter()
            for name, word, n in counts:
                if name == lang:
                    for part in pieced(word):
                        bag[part] += n
            words, weights = list(bag), np.array(list(bag.values()), float)
            p = np.full((len(vocab.pieces), 1), 1 / max(1, len(vocab.pieces)))
            for _ in range(rounds):
                use = expected_counts(vocab, p, words, weights) + smoothing
                p = (use / use.sum())[:, None]
            probs[:, k] = p[:, 0]
        total = sum(docs.values())
        return cls(vocab, langs, np.log([docs[x] / total for x in langs]), probs)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Most probable language and its posterior, per text."""
        seen: dict[bytes, int] = {}
        index, sizes = [], []
        for text in texts:
            words = words_of(text)
            index.extend([seen.setdefault(w, len(seen)) for w in words])
            sizes.append(len(words))
        parts, owner = [], []
        for w, i in seen.items():
            cut = pieced(w)
            parts.extend(cut)
            owner.extend([i] * len(cut))
        scores = np.zeros((len(seen) + 1, len(self.langs)))
        np.add.at(scores, np.array(owner, np.int64), word_scores(self.vocab, self.probs, parts))
        edges = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        index = np.array(index, np.int64)
        langs, posts = [], []
        for i, text in enumerate(texts):
            if not text or not self.langs or not has_letter(text):
                langs.append(UNDETERMINED)
                posts.append(0.0)
                continue
            total = self.priors + scores[index[edges[i]:edges[i + 1]]].sum(axis=0)
            best = int(np.argmax(total))
            langs.append(self.langs[best])
            posts.append(float(1 / np.exp(total - total[best]).sum()))
        return langs, posts


def vocabulary(path: str) -> list[str]:
    """The normal pieces of a sentencepiece model, lower-cased."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [model.id_to_piece(i).lower() for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]


def fit(docs: DataFrame, vocab_path: str, train_docs: int = 4000) -> Model:
    """Learn from the rows with a language that are not held out.

    At most about ``train_docs`` of them, an equal number per language, chosen
    by a hash of id and text; the words of these are counted on the executors.
    """
    known = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    bound_batches(docs.sparkSession)
    sizes = {r[0]: r[1] for r in known.groupBy("lang").count().collect()}
    each = max(1, train_docs // max(1, len(sizes)))
    pick = F.lit(False)
    for lang, n in sizes.items():
        pick = pick | ((F.col("lang") == lang) & sampled(F.xxhash64("doc_id", "text"), min(1.0, each / n), "language"))

    def count(batches):
        for batch in batches:
            bag: Counter[tuple[str, bytes]] = Counter()
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                bag.update((lang, w) for w in words_of(text))
            yield pa.record_batch([pa.array([k[0] for k in bag], pa.string()),
                                   pa.array([k[1] for k in bag], pa.binary()),
                                   pa.array(bag.values(), pa.int64())], names=["lang", "word", "n"])
            release()

    counts = (known.where(pick).select("text", "lang").mapInArrow(count, "lang string, word binary, n bigint")
              .groupBy("lang", "word").agg(F.sum("n").alias("n")))
    rows = counts.toArrow().to_pydict()
    order = sorted(zip(rows["lang"], rows["word"], rows["n"]))
    return Model.fit(vocabulary(vocab_path), order, sizes)


def identify(docs: DataFrame, model: Model, with_text: bool = False) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row, and its ``text`` if asked for;
    ``doc_id`` may be of any type."""
    tables = ship(docs.sparkSession, model)

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs, posts = tables().predict(batch.column(1).to_pylist())
        return pa.record_batch([*(batch.columns if with_text else batch.columns[:1]), pa.array(langs, pa.string()),
                                pa.array(posts, pa.float64())],
                               names=["doc_id", *(["text"] if with_text else []), "lang_pred", "score"])

    return arrow_map(docs.select("doc_id", F.col("text").cast("string").alias("text")), score,
                     schema(docs.schema["doc_id"], ("text string, " if with_text else "") + "lang_pred string, score double"))
