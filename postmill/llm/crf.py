"""Language of words and texts by a linear-chain conditional random field.

A word's features are its affixes, its letter n-grams and what a learned lexicon says of
it; their weights and the transitions between languages are learned together by
stochastic gradient ascent on the conditional likelihood, whose gradient needs the
forward-backward marginals. As given texts have one language each, training sequences
are pieces of different texts put together, so that transitions are learned for
code-switched text.

A text's words get marginals by forward-backward. Chains are cut into pieces of STEPS
words; products of a piece's transition matrices carry the messages from piece to piece,
so all pieces of all texts of a batch advance together and results are exact. With more
than COLUMNS labels these products cost more than they save, and a text's pieces follow
each other instead.

Every language of the training rows is a label. The rows are a bounded sample: of each
language about SAMPLE, or, where that is more than ROWS in all, an equal share of ROWS
but no fewer than LEAST; chosen by hash, with PIECES stretches of PIECE words spread over
the whole text. Prediction reads every word of every text.

Defined cases: null text and text without a letter are `und` with score 0. Words without
a letter say nothing. Rows without doc_id are held out. Without training rows all are
`und`. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postmill.llm.arrays import U64, mix, pieces
from postmill.llm.known_ids import ranges

FOLDS = 5
SAMPLE, ROWS, LEAST = 300, 9600, 50
COLUMNS = 32
PIECES, PIECE = 12, 15
FEATURES = 1 << 17
EPOCHS = 4
RATE = 0.3
STEPS = 32
REMEMBERED = 300_000
LEXICON = 20_000
UNKNOWN = "und"


def core_of(word: str) -> str:
    """The word's letters in lower case."""
    low = word.lower()
    return low if low.isalpha() else "".join(filter(str.isalpha, low))


def word_features(words: list[str], lexicon: dict[str, int], features: int = FEATURES) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of all words, word after word and each once, and the number of each; none if a word has no letter."""
    cores = [core_of(w) for w in words]
    has = np.flatnonzero(np.array([len(c) for c in cores], np.int64))
    if not len(has):
        return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
    cores = [cores[i] for i in has.tolist()]
    code = np.frombuffer("".join(f"<{c}>" for c in cores).encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.array([len(c) + 2 for c in cores], np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    word = np.repeat(np.arange(len(cores)), sizes)
    entry = np.array([lexicon.get(c, -1) for c in cores], np.int64)
    owners, hashes = [np.arange(len(cores))], [mix((entry + 2).astype(np.uint64) + U64(1 << 40))]

    def add(kind: int, at: np.ndarray, n: int) -> None:
        value = np.full(len(at), 8 * kind + n, np.uint64)
        for j in range(n):
            value = value * U64(0x9E3779B97F4A7C15) + code[at + j]
        owners.append(word[at])
        hashes.append(mix(value))

    for n in (2, 3, 4):
        at = np.arange(len(code))
        add(1, at[at + n <= ends[word]], n)
    for n in (1, 2, 3):
        long = sizes - 2 >= n
        add(2, starts[long] + 1, n)
        add(3, ends[long] - 1 - n, n)
    place = (np.concatenate(hashes) % U64(features)).astype(np.int64)
    keys = np.sort(np.concatenate(owners) * features + place)
    keys = keys[np.diff(keys, prepend=-1) > 0]
    return keys % features, np.bincount(has[keys // features], minlength=len(words))


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # features x labels
    transitions: np.ndarray  # labels x labels
    lexicon: dict[str, int]

    def scores(self, words: list[str]) -> np.ndarray:
        """Emission scores per word and label."""
        return emissions(*word_features(words, self.lexicon, len(self.weights)), self.weights)


def columns(k: int) -> list[slice]:
    """The labels in blocks of COLUMNS, so that what is gathered per feature stays small."""
    return [slice(j, min(j + COLUMNS, k)) for j in range(0, k, COLUMNS)]


def emissions(flat: np.ndarray, sizes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Mean weight of each word's features, times the square root of their number."""
    out = np.zeros((len(sizes), weights.shape[1]), np.float32)
    has = np.flatnonzero(sizes)
    if len(has):
        starts = np.concatenate([[0], np.cumsum(sizes[has])[:-1]])
        for part in columns(weights.shape[1]):
            out[has, part] = np.add.reduceat(weights[flat, part], starts) / np.sqrt(sizes[has])[:, None]
    return out


def forward_backward(scores: np.ndarray, counts: np.ndarray, transitions: np.ndarray, steps: int = STEPS, expect: bool = True):
    """Marginals of every word, and expected transitions between neighbours, summed over all (zero unless `expect`).

    scores: emission scores of all words, text after text; counts: words per text.
    """
    total, k = scores.shape
    if not total:
        return scores.astype(np.float64), np.zeros((k, k))
    move = np.exp(transitions - transitions.max())
    emit = np.exp((scores - scores.max(axis=1, keepdims=True)).astype(np.float64))
    own = counts[counts > 0]
    per = -(-own // steps)
    piece_text = np.repeat(np.arange(len(own)), per)
    inside = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
    sizes = np.minimum(steps, own[piece_text] - inside * steps)
    starts = np.cumsum(sizes) - sizes
    n = len(sizes)
    cells = np.zeros((steps, n, k))
    valid = np.arange(steps)[:, None] < sizes[None, :]
    cells[valid] = emit[(starts[None, :] + np.arange(steps)[:, None])[valid]]
    first = inside == 0

    into, outof = np.ones((n, k)) / k, np.ones((n, k)) / k
    last = np.cumsum(per) - 1
    if k <= COLUMNS:
        # Product of each piece's steps; the first word of a text has no transition into it.
        product = np.broadcast_to(np.eye(k), (n, k, k)).copy()
        for t in range(steps):
            grown = (product.reshape(-1, k) @ move).reshape(n, k, k)
            if t == 0:
                grown[first] = product[first]
            grown *= cells[t][:, None, :]
            over = ~valid[t]
            grown[over] = product[over]
            product = grown / grown.reshape(n, -1).sum(axis=1)[:, None, None]
        at = np.flatnonzero(first)
        for i in range(1, int(per.max())):
            now = at[per > i] + i
            message = np.einsum("nk,nkj->nj", into[now - 1], product[now - 1])
            into[now] = message / message.sum(axis=1, keepdims=True)
        for i in range(1, int(per.max())):
            now = last[per > i] - i
            message = np.einsum("nkj,nj->nk", product[now + 1], outof[now + 1])
            outof[now] = message / message.sum(axis=1, keepdims=True)
        # All pieces at once: slices, so that a step copies nothing.
        rounds = [slice(None)]
    else:
        # First pieces of all texts, second pieces, and so on.
        rounds = np.split(np.argsort(inside, kind="stable"), np.cumsum(np.bincount(inside))[:-1])
    ends = np.zeros(n, bool)
    ends[last] = True

    ahead = np.zeros((steps, n, k))
    for at in rounds:
        state = into[at]
        for t in range(steps):
            moved = state @ move
            if t == 0:
                moved = np.where(first[at][:, None], state, moved)
            now = moved * cells[t, at]
            now = now / np.maximum(now.sum(axis=1, keepdims=True), 1e-300)
            state = np.where(valid[t, at][:, None], now, state)
            ahead[t, at] = state
        if len(rounds) > 1:
            into[at[~ends[at]] + 1] = state[~ends[at]]
    marginal = np.zeros((steps, n, k))
    expected = np.zeros((k, k))
    for at in reversed(rounds):
        back = outof[at]
        for t in range(steps - 1, -1, -1):
            both = ahead[t, at] * back
            both = both / both.sum(axis=1, keepdims=True)
            marginal[t, at] = both
            here = cells[t, at] * back
            gone = here @ move.T
            if expect:
                live = valid[t, at] & ~first[at] if t == 0 else valid[t, at]
                before = ahead[t - 1, at] if t else into[at]
                # Each pair's before x move x here, divided by its sum, added over all pairs.
                total_of = np.maximum((before[live] * gone[live]).sum(axis=1, keepdims=True), 1e-300)
                expected += move * ((before[live] / total_of).T @ here[live])
            gone = gone / np.maximum(gone.sum(axis=1, keepdims=True), 1e-300)
            back = np.where(valid[t, at][:, None], gone, back)
        if len(rounds) > 1:
            outof[at[~first[at]] - 1] = back[~first[at]]
    result = np.zeros((total, k))
    result[(starts[None, :] + np.arange(steps)[:, None])[valid]] = marginal[valid]
    return result, expected


def train(rows: list[tuple[str, str]], features: int = FEATURES, epochs: int = EPOCHS, seed: int = 7) -> Model | None:
    """Fit a model to (text, language) rows."""
    labels = sorted({lang for _, lang in rows})
    if not labels:
        return None
    rng = np.random.default_rng(seed)
    stretches: list[tuple[int, list[str]]] = []
    for text, lang in rows:
        words = text.split()
        starts = np.unique(np.linspace(0, max(0, len(words) - PIECE), PIECES).astype(int))
        stretches += [(labels.index(lang), words[s : s + PIECE]) for s in starts if words]
    seen: dict[str, Counter[int]] = {}
    for label, words in stretches:
        for w in words:
            core = core_of(w)
            if core:
                seen.setdefault(core, Counter())[label] += 1
    common = sorted((w for w in seen if seen[w].total() >= 3), key=lambda w: (-seen[w].total(), w))[:LEXICON]
    # A lexicon entry: the word's usual language and how sure that is, in three steps.
    usual = {w: min(seen[w], key=lambda label, of=seen[w]: (-of[label], label)) for w in common}
    lexicon = {w: label * 3 + int(2.999 * seen[w][label] / seen[w].total()) for w, label in usual.items()}
    vocabulary = sorted({w for _, words in stretches for w in words})
    number = {w: i for i, w in enumerate(vocabulary)}
    every, lengths = word_features(vocabulary, lexicon, features)
    begins = np.cumsum(lengths) - lengths
    k = len(labels)
    weights, moves = np.zeros((features, k), np.float32), np.zeros((k, k))
    grown, moved = np.full((features, k), 1e-6, np.float32), np.full((k, k), 1e-6)
    for _ in range(epochs):
        order = rng.permutation(len(stretches))
        for start in range(0, len(order), 256):
            # Four stretches, mostly of different languages, make a sequence.
            batch = [stretches[i] for i in order[start : start + 256]]
            words = np.array([number[w] for _, part in batch for w in part], np.int64)
            truth = np.repeat([label for label, _ in batch], [len(part) for _, part in batch])
            counts = np.array([sum(len(part) for _, part in batch[i : i + 4]) for i in range(0, len(batch), 4)])
            sizes = lengths[words]
            flat = every[ranges(begins[words], sizes)]
            marginal, expected = forward_backward(emissions(flat, sizes, weights), counts, moves)
            error = -marginal
            error[np.arange(len(truth)), truth] += 1
            error = error / np.sqrt(np.maximum(sizes, 1))[:, None]
            places, slot = np.unique(flat, return_inverse=True)
            for part in columns(k):
                share = np.repeat(error[:, part], sizes, axis=0)
                step = np.stack([np.bincount(slot, own_share, len(places)) for own_share in share.T], axis=1) - 1e-4 * weights[places, part]
                grown[places, part] += step**2
                weights[places, part] += RATE * step / np.sqrt(grown[places, part])
            joint = np.zeros((k, k))
            joined = np.ones(len(truth), bool)
            joined[np.cumsum(counts)[:-1]] = False
            inner = np.flatnonzero(joined)[1:]
            np.add.at(joint, (truth[inner - 1], truth[inner]), 1)
            step = joint - expected - 1e-3 * moves
            moved += step**2
            moves += RATE * step / np.sqrt(moved)
    return Model(labels, weights, moves, lexicon)


class Labeller:
    """Predicts texts with a model, remembering the scores of words."""

    def __init__(self, model: Model):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.table = np.zeros((0, len(self.model.labels)), np.float32)
        self.lettered = np.zeros(0, bool)

    def words(self, texts: list[str]):
        """Marginals of all words, which words have a letter, and words per text."""
        if len(self.known) > REMEMBERED * COLUMNS // max(COLUMNS, len(self.model.labels)):
            self.forget()
        split = [t.split() for t in texts]
        new = sorted(set().union(*split) - self.known.keys())
        if new:
            base = len(self.known)
            self.known.update({w: base + i for i, w in enumerate(new)})
            self.table = np.concatenate([self.table, self.model.scores(new)])
            self.lettered = np.concatenate([self.lettered, np.array([any(map(str.isalpha, w)) for w in new], bool)])
        numbers: list[int] = []
        for part in split:
            numbers.extend(map(self.known.__getitem__, part))
        number = np.array(numbers, np.int64)
        counts = np.array([len(part) for part in split], np.int64)
        marginal, _ = forward_backward(self.table[number], counts, self.model.transitions, expect=False)
        return marginal, self.lettered[number], counts

    def texts(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """Language and score (mean marginal of its lettered words) of each text."""
        marginal, lettered, counts = self.words(texts)
        owner = np.repeat(np.arange(len(texts)), counts)[lettered]
        k = len(self.model.labels)
        total = np.stack([np.bincount(owner, marginal[lettered, j], len(texts)) for j in range(k)], axis=1)
        number = np.bincount(owner, minlength=len(texts))
        best = total.argmax(axis=1)
        score = total[np.arange(len(texts)), best] / np.maximum(number, 1)
        return [self.model.labels[b] if n else UNKNOWN for b, n in zip(best, number, strict=True)], np.clip(score, 0.0, 1.0).tolist()


_latest: list = [None, None]


def labeller_of(model: Model | None) -> Labeller | None:
    """The worker's labeller of a model: words that one task has met serve the next."""
    if model is None:
        return None
    if _latest[0] is not model:
        _latest[:] = model, Labeller(model)
    return _latest[1]


def held_out(doc_id) -> object:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(True))


def training_rows(docs: DataFrame, sample: int = SAMPLE, rows: int = ROWS, least: int = LEAST) -> list[tuple[str, str]]:
    """(text, lang) rows of every language, chosen by hash: of each about `sample`, or its share of `rows`."""
    given = docs.where(~held_out(F.col("doc_id"))).where("lang is not null and text is not null")
    place = F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    counts = given.groupBy("lang").agg(F.count("*").alias("count"), F.min(place).alias("first")).orderBy("lang").collect()
    if not counts:
        return []
    sample = min(sample, max(least, rows // len(counts)))
    # Where ids repeat all may lie beyond the share: the first place is always in.
    large = [x for r in counts if r["count"] > sample for x in (r["lang"], max(sample / r["count"], math.nextafter(r["first"], 1)))]
    share = F.coalesce(F.element_at(F.create_map(*map(F.lit, large)), F.col("lang")), F.lit(1.0)) if large else F.lit(1.0)
    # Stretches are cut on the executors, so a long text sends no more than a short one.
    words = F.split("text", r"\s+")
    room = F.greatest(F.size(words) - PIECE, F.lit(0))
    cuts = F.transform(F.sequence(F.lit(0), F.lit(PIECES - 1)), lambda i: F.slice(words, (room * i / (PIECES - 1)).cast("int") + 1, F.lit(PIECE)))
    text = F.when(F.size(words) <= PIECE * PIECES, words).otherwise(F.flatten(cuts))
    chosen = given.where(place < share).select(place.alias("place"), "doc_id", "lang", F.array_join(text, " ").alias("text"))
    # A doc_id on very many rows takes no other language's room.
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("place", "doc_id", "text"))
    chosen = chosen.withColumn("nth", nth).where(F.col("nth") <= 2 * sample)
    return [(r.text, r.lang) for r in chosen.orderBy("place", "doc_id", "lang", "text").select("text", "lang").collect()]


def predicted(docs: DataFrame, model: Model | None) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    most = (1 << 21) * COLUMNS // max(COLUMNS, len(model.labels) if model else 0)

    def label(batches):
        labeller = labeller_of(sent.value)
        for batch in pieces(batches, "text", most):
            texts = batch.column("text").to_pylist()
            langs, scores = labeller.texts(texts) if labeller else ([UNKNOWN] * len(texts), [0.0] * len(texts))
            yield pa.record_batch([batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    return given.mapInArrow(label, "doc_id long, held_out boolean, lang_pred string, score double")


def languages(docs: DataFrame) -> DataFrame:
    """Train on the sample and predict every document."""
    return predicted(docs, train(training_rows(docs)))
