"""Language identification by a linear-chain conditional random field over words.

Every word of a text gets a language label; affixes, character n-grams and a lexicon are the emission features, transitions are learned, and
forward-backward gives each word's posterior. A document's language is the label with the largest posterior mass, words weighted by their letters;
its score is that share. Training uses a bounded, hash-ordered sample of labelled documents (`max_train_rows`); since a labelled
document has one language, switched chains are spliced from documents of different languages so that transitions are learned too.

Defined results: a text that is null or has no letter is `und` with score 0.0; without training rows everything is `und`; ties go to the first label in order.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kbweave.llm.common import with_struct

#: A run of letters; longer ones (texts without spaces) are words of this many letters one after another.
LONGEST = 40
WORD = re.compile(rf"[^\W\d_]{{1,{LONGEST}}}")


def _numerals(first: int, last: int) -> re.Pattern[str]:
    """All numbers that are neither digits nor letters, which the word pattern would let through."""
    return re.compile("[" + "".join(x for x in map(chr, range(first, last + 1)) if x.isalnum() and not x.isalpha() and not x.isdecimal()) + "]")


#: Two patterns, since a class within the first plane is one table and a class beyond it a list.
NUMERIC, FAR_NUMERIC = _numerals(0, 0xFFFF), _numerals(0x10000, sys.maxunicode)
FAR = re.compile("[\U00010000-\U0010ffff]")
UND = "und"


@dataclass(frozen=True)
class Settings:
    max_train_rows: int = 1500  # bound of the training sample, by the hash of doc_id
    max_train_bytes: int = 1 << 18  # of a training text; with max_train_rows this bounds what the driver holds
    bits: int = 15  # hashed features
    lexicon: int = 2000  # words
    epochs: int = 4
    rate: float = 0.15
    l2: float = 1e-6
    chain_words: int = 64  # of a training chain
    cache_words: int = 200_000
    block_words: int = 1 << 16  # that are labelled at a time
    line_words: int = 512  # of a chain; longer lines are several chains, so that they are walked in step
    seed: int = 7


@dataclass
class Crf:
    labels: list[str]
    settings: Settings
    weights: np.ndarray  # features x labels
    transitions: np.ndarray  # from x to
    start: np.ndarray
    lexicon: dict[str, int] = field(default_factory=dict)


def words_of(text: str) -> list[str]:
    if not text.isascii():
        text = NUMERIC.sub(" ", text)
        if FAR.search(text):
            text = FAR_NUMERIC.sub(" ", text)
    return WORD.findall(text.lower())


def featurize(words: list[str], lexicon: dict[str, int], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(feature ids, offsets): for each word its n-grams of 1 to 4 characters with word ends (affixes are those that touch an end) and its lexicon entry."""
    space = 1 << bits
    padded = ["\x02" + w + "\x03" for w in words]
    codes = np.frombuffer("".join(padded).encode("utf-32-le"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, padded), np.int64, len(padded))
    ends = np.cumsum(lengths)
    owner = np.repeat(np.arange(len(padded)), lengths)
    room = ends[owner] - np.arange(len(codes))  # characters from here to the end of the word
    ids, of = [], []
    rolled = np.zeros(len(codes), np.uint64)
    for n in range(1, 5):
        if len(codes) < n:
            break
        rolled = rolled[: len(codes) - n + 1] * np.uint64(1000003) + codes[n - 1 :] + np.uint64(n)
        fits = room[: len(rolled)] >= n
        mixed = (rolled[fits] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)
        ids.append(mixed.astype(np.int64))
        of.append(owner[: len(rolled)][fits])
    known = np.fromiter((lexicon.get(w, -1) for w in words), np.int64, len(words))
    has = np.flatnonzero(known >= 0)
    ids.append(space + known[has])
    of.append(has)
    ids, of = np.concatenate(ids), np.concatenate(of)
    order = np.argsort(of, kind="stable")
    return ids[order], np.searchsorted(of[order], np.arange(len(words)))


def emissions(words: list[str], crf: Crf) -> np.ndarray:
    """words x labels; the mean weight of a word's features."""
    if not words:
        return np.zeros((0, len(crf.labels)))
    ids, at = featurize(words, crf.lexicon, crf.settings.bits)
    sums = np.add.reduceat(crf.weights[ids], at, axis=0)
    return sums / np.sqrt(np.diff(np.append(at, len(ids))))[:, None]


def forward_backward(scores: np.ndarray, lengths: np.ndarray, crf: Crf) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(forward, backward, potentials, transitions), each word's up to a factor, over many chains at once: scores are the chains' emissions one after another.

    Chains are walked in step, the longest first, so that each step works on those which are still open.
    """
    k = scores.shape[1]
    order = np.argsort(-lengths, kind="stable")
    lengths = lengths[order]
    starts = np.concatenate([[0], np.cumsum(lengths[np.argsort(order)])])[:-1][order] if len(order) else np.zeros(0, np.int64)
    open_at = np.searchsorted(-lengths, -np.arange(int(lengths[0]) if len(lengths) else 0), "left")
    potential = np.exp(scores - scores.max(axis=1, keepdims=True))
    move = np.exp(crf.transitions - crf.transitions.max())
    ahead = np.empty_like(potential)
    back = np.empty_like(potential)
    state = None
    for t, m in enumerate(open_at):
        at = starts[:m] + t
        state = potential[at] * (np.exp(crf.start) if t == 0 else state[:m] @ move)
        state /= state.sum(axis=1, keepdims=True)
        ahead[at] = state
    state = np.zeros((0, k))
    for t in range(len(open_at) - 1, -1, -1):
        m = open_at[t]
        at = starts[:m] + t
        ended = m - len(state)
        if len(state):
            nxt = (state * potential[starts[: len(state)] + t + 1]) @ move.T
            nxt /= nxt.sum(axis=1, keepdims=True)
            state = np.concatenate([nxt, np.ones((ended, k))]) if ended else nxt
        else:
            state = np.ones((m, k))
        back[at] = state
    return ahead, back, potential, move


def posteriors(scores: np.ndarray, lengths: np.ndarray, crf: Crf) -> np.ndarray:
    """Probability of every label of every word, of the shape of scores."""
    ahead, back, _, _ = forward_backward(scores, lengths, crf)
    out = ahead * back
    return out / out.sum(axis=1, keepdims=True)


def gradients(scores: np.ndarray, lengths: np.ndarray, truth: np.ndarray, crf: Crf) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gradients of the chains' log-likelihood by the emissions, the transitions and the start weights."""
    ahead, back, potential, move = forward_backward(scores, lengths, crf)
    error = -ahead * back
    error /= -error.sum(axis=1, keepdims=True)
    error[np.arange(len(truth)), truth] += 1
    first = np.cumsum(lengths) - lengths
    inside = np.ones(len(truth), bool)
    inside[np.cumsum(lengths) - 1] = False
    a = np.flatnonzero(inside)
    pair = ahead[a][:, :, None] * move[None] * (potential[a + 1] * back[a + 1])[:, None, :]
    pair /= pair.sum(axis=(1, 2), keepdims=True)
    by_move = -pair.sum(axis=0)
    np.add.at(by_move, (truth[a], truth[a + 1]), 1)
    return error, by_move, error[first].sum(axis=0)


def train(rows: list[tuple[str, str]], settings: Settings = Settings()) -> Crf:
    """rows: (text, label). Stochastic gradient ascent on the chains' conditional log-likelihood."""
    labels = sorted({label for _, label in rows})
    rng = np.random.default_rng(settings.seed)
    k = len(labels)
    counts: Counter[str] = Counter()
    for text, _ in rows:
        counts.update(set(words_of(text)))
    lexicon = {w: i for i, (w, _) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0]))[: settings.lexicon])}
    crf = Crf(labels, settings, np.zeros(((1 << settings.bits) + len(lexicon), k)), np.zeros((k, k)), np.zeros(k), lexicon)
    if k < 2:
        return crf
    chains: dict[int, list[list[str]]] = {y: [] for y in range(k)}
    for text, label in rows:
        words = words_of(text)
        for s in range(0, len(words), settings.chain_words):
            chains[labels.index(label)].append(words[s : s + settings.chain_words])
    # languages weigh alike: each gives as many chains as the median language has, with repetition where it has fewer
    most = int(np.median([max(1, len(c)) for c in chains.values()]))
    drawn = [(chains[y][i], y) for y in range(k) if chains[y] for i in rng.permutation(len(chains[y]))[:most]]
    pool = [[(w, y) for w in words] for words, y in drawn if words]
    rng.shuffle(pool)
    spliced = []
    for a, b in zip(pool[::3], pool[1::3], strict=False):
        cut = int(rng.integers(1, len(a) + 1))
        spliced.append(a[:cut] + b[: settings.chain_words - cut] + a[cut:])
    pool += spliced
    grad_w, grad_t, grad_s = (np.full_like(x, 1e-8) for x in (crf.weights, crf.transitions, crf.start))
    for _ in range(settings.epochs):
        order = rng.permutation(len(pool))
        for s in range(0, len(pool), 64):
            batch = [pool[i] for i in order[s : s + 64]]
            words = [w for c in batch for w, _ in c]
            truth = np.asarray([y for c in batch for _, y in c])
            lengths = np.asarray([len(c) for c in batch])
            ids, at = featurize(words, lexicon, settings.bits)
            per = np.diff(np.append(at, len(ids)))
            scores = np.add.reduceat(crf.weights[ids], at, axis=0) / np.sqrt(per)[:, None]
            error, move, begin = (g / len(words) for g in gradients(scores, lengths, truth, crf))
            spread = np.repeat(error / np.sqrt(per)[:, None], per, axis=0)
            used, inverse = np.unique(ids, return_inverse=True)
            step = np.stack([np.bincount(inverse, spread[:, j], len(used)) for j in range(k)], axis=1) - settings.l2 * crf.weights[used]
            grad_w[used] += step**2
            crf.weights[used] += settings.rate * step / np.sqrt(grad_w[used])
            grad_t += move**2
            crf.transitions += settings.rate * move / np.sqrt(grad_t)
            grad_s += begin**2
            crf.start += settings.rate * begin / np.sqrt(grad_s)
    return crf


class Labeler:
    """Document languages with a bounded cache of word emissions; chains are lines, cut after every `line_words` words."""

    def __init__(self, crf: Crf):
        self.crf = crf
        self.cache: dict[str, int] = {}
        self.rows = np.zeros((0, len(crf.labels)))

    def _rows_of(self, words: list[str]) -> np.ndarray:
        if len(self.cache) > self.crf.settings.cache_words:
            self.cache.clear()
            self.rows = self.rows[:0]
        missing = [w for w in dict.fromkeys(words) if w not in self.cache]
        if missing:
            base = len(self.cache)
            self.cache.update(zip(missing, range(base, base + len(missing)), strict=True))
            self.rows = np.concatenate([self.rows[:base], emissions(missing, self.crf)])
        return self.rows[np.fromiter(map(self.cache.__getitem__, words), np.int64, len(words))]

    def label(self, texts: list[str | None]) -> list[tuple[str, float, list[float]]]:
        k = len(self.crf.labels)
        mass = np.zeros((len(texts), k))
        words: list[str] = []
        lengths: list[int] = []
        owners: list[int] = []

        def weigh() -> None:
            if words and k > 1:
                post = posteriors(self._rows_of(words), np.asarray(lengths), self.crf)
                letters = np.fromiter(map(len, words), np.float64, len(words))
                owner = np.repeat(np.asarray(owners), lengths)
                for j in range(k):
                    mass[:, j] += np.bincount(owner, post[:, j] * letters, len(texts))
            elif words and k == 1:
                mass[owners, 0] = 1
            words.clear(), lengths.clear(), owners.clear()

        block, longest = self.crf.settings.block_words, self.crf.settings.line_words
        for i, text in enumerate(texts):
            if len(words) >= block:
                weigh()
            own = 0  # of this text in the block, so that its sums do not depend on its neighbours
            for line in (text or "").split("\n"):
                found = words_of(line)
                for s in range(0, len(found), longest):
                    part = found[s : s + longest]
                    words.extend(part)
                    lengths.append(len(part))
                    owners.append(i)
                    own += len(part)
                    if own >= block:
                        weigh()
                        own = 0
        weigh()
        total = mass.sum(axis=1)
        best = mass.argmax(axis=1) if k else np.zeros(len(texts), int)
        return [(self.crf.labels[b], float(mass[i, b] / total[i]), (mass[i] / total[i]).tolist()) if total[i] > 0 else (UND, 0.0, []) for i, b in enumerate(best)]


FIELDS = [T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("shares", T.ArrayType(T.DoubleType()))]


def fit(docs: DataFrame, usable: Column, id_column: str = "doc_id", text: str = "text", label: str = "lang", settings: Settings = Settings()) -> Crf:
    """Train on at most max_train_rows of the rows where `usable` holds and the text has at most max_train_bytes, in the order of the id's hash.

    The ids are chosen from the narrow columns first; only then are the chosen texts read, one for an id and language (the least of several), so that the sample,
    and the model, is the same in every run.
    """
    given = docs.where(usable & F.col(text).isNotNull() & F.col(label).isNotNull() & (F.octet_length(F.col(text)) <= settings.max_train_bytes)).select(F.xxhash64(F.col(id_column).cast("string")).alias("h"), F.col(text).alias("text"), F.col(label).alias("label"))
    last = given.select("h").distinct().orderBy("h").limit(settings.max_train_rows).agg(F.max("h")).first()[0]
    if last is None:
        return Crf([], settings, np.zeros((0, 0)), np.zeros((0, 0)), np.zeros(0))
    picked = given.where(F.col("h") <= last).groupBy("h", "label").agg(F.min("text").alias("text"))
    rows = picked.orderBy("h", "label").limit(settings.max_train_rows).select("text", "label").collect()
    return train(sorted((r[0], r[1]) for r in rows), settings)


def identify(docs: DataFrame, crf: Crf, text: str = "text", out: str = "language") -> DataFrame:
    """docs plus the struct `out`: lang, score and the posterior shares in the order of the model's labels."""
    model = docs.sparkSession.sparkContext.broadcast(crf)

    def make() -> Callable[[pa.Array], list[pa.Array]]:
        labeler = Labeler(model.value)

        def work(texts: pa.Array) -> list[pa.Array]:
            found = labeler.label(texts.to_pylist())
            lang, score, shares = zip(*found, strict=True)
            return [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(shares, pa.list_(pa.float64()))]

        return work

    return with_struct(docs, make, FIELDS, out, text)
