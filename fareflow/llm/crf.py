"""Language of code-switched text: a linear-chain CRF over words, read by forward-backward.

A word's emission is the sum of learned weights of its character n-grams, its prefix and
suffix (n-grams of the word between end marks, up to four long) and the lexicons it stands in.
Transitions between the labels of neighbouring words are learned too. A text's language is
the label with the largest expected share of its words.

The model is fitted on the driver to a bounded sample of labelled rows (``DOCS_PER_LANGUAGE``
texts of ``SAMPLE_CHARS`` characters each). Training sequences splice stretches of different
languages, so the transitions see switches. Prediction is one Arrow pass without a shuffle.

Chains of any length are read in blocks of ``BLOCK`` words: first every block's product of
step matrices, then the messages from block to block, then the words inside. The result is that
of one long pass, but all blocks of a batch advance together.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareflow.llm.common import free_name, small_batches

DOCS_PER_LANGUAGE = 250
SAMPLE_CHARS = 2_000
# Labels that one table of weights may hold; more are an error.
MOST_LABELS = 256
HELD_OUT_OF = 5
UNKNOWN = "und"

HASH_BITS = 17
BLOCK = 32
WORDS_AT_ONCE = 200_000
CELLS_AT_ONCE = 1 << 24  # words by pairs of labels
SEQUENCE = 32
STRETCH = (4, 24)
EPOCHS = 4
MINIBATCH = 64
RATE = 0.25
DECAY = 1e-4
LEXICON_SHARE = 0.8
LEXICON_COUNT = 3

_WORD = re.compile(r"[^\W\d_]+")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text) if text else []


@dataclass
class Crf:
    labels: list[str]
    weights: np.ndarray  # feature x label
    moves: np.ndarray  # label x label, log
    lexicon: dict[str, int] = field(default_factory=dict)

    def features(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Feature numbers of all words in a row, and where each word's begin."""
        low = [w.lower() for w in words]
        flat = np.frombuffer(("^" + "$^".join(low) + "$").encode("utf-32-le"), dtype=np.uint32)
        size = np.array([len(w) + 2 for w in low])
        begin = np.cumsum(size) - size
        end = np.repeat(begin + size, size)
        first = np.repeat(begin, size)
        at = np.arange(len(flat))
        grams, owners = [], []
        owner = np.repeat(np.arange(len(words)), size)
        for n in (2, 3, 4):
            inside = at + n <= end
            if n == 4:  # four long only at either end of the word
                inside &= (at == first) | (at + n == end)
            place = at[inside]
            code = np.full(len(place), n, dtype=np.uint64)
            for k in range(n):
                code = (code + flat[place + k]) * _MULTIPLIER
                code ^= code >> np.uint64(29)
            grams.append((code >> np.uint64(64 - HASH_BITS)).astype(np.int64))
            owners.append(owner[inside])
        listed = np.array([self.lexicon.get(w, len(self.labels)) for w in low], dtype=np.int64)
        grams.append(listed + (1 << HASH_BITS))
        owners.append(np.arange(len(words)))
        ids, owner = np.concatenate(grams), np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        return ids[order], np.searchsorted(owner[order], np.arange(len(words)))

    def emissions(self, words: list[str]) -> np.ndarray:
        """Log potentials of the labels, one row per word; ``words`` is not empty."""
        ids, begin = self.features(words)
        return np.add.reduceat(self.weights[ids], begin, axis=0)

    def shares(self, texts: list[list[str]]) -> np.ndarray:
        """The expected share of each label among the words of each text."""
        return self.read(texts)[0]

    def read(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Each label's expected share of each text's words, and how sure the words are of theirs:
        the mean probability of a word's likeliest label."""
        out, sure = np.zeros((len(texts), len(self.labels))), np.zeros(len(texts))
        if not self.labels:
            return out, sure
        at_once = min(WORDS_AT_ONCE, CELLS_AT_ONCE // len(self.labels) ** 2)
        for run in _runs([len(t) for t in texts], at_once):
            flat = [w for i in run for w in texts[i]]
            codes, kinds = pd.factorize(np.array(flat, dtype=object))
            potentials = self.emissions(list(kinds))
            potentials = np.exp(potentials - potentials.max(axis=1, keepdims=True))
            sizes = np.array([len(texts[i]) for i in run])
            found = marginals(potentials, codes, sizes, np.exp(self.moves))
            begin = np.cumsum(sizes) - sizes
            out[run] = np.add.reduceat(found, begin, axis=0) / sizes[:, None]
            sure[run] = np.add.reduceat(found.max(axis=1), begin) / sizes
        return out, sure


def _runs(sizes: list[int], limit: int) -> Iterator[list[int]]:
    """Indexes of non-empty texts in runs of about ``limit`` words; no text is cut."""
    run, held = [], 0
    for i, size in enumerate(sizes):
        if size and held and held + size > limit:
            yield run
            run, held = [], 0
        if size:
            run.append(i)
            held += size
    if run:
        yield run


def _normed(x: np.ndarray) -> np.ndarray:
    axes = tuple(range(1, x.ndim))
    return x / x.sum(axis=axes, keepdims=True)


def marginals(kinds: np.ndarray, codes: np.ndarray, sizes: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Label probabilities of every word; ``kinds[codes]`` are the words' potentials.

    The texts lie one after another. A text starts with all labels alike.
    """
    count = moves.shape[0]
    texts = len(sizes)
    per = -(-sizes // BLOCK)
    text = np.repeat(np.arange(texts), per)
    rank = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)
    begin = np.repeat(np.cumsum(sizes) - sizes, per) + rank * BLOCK
    length = np.minimum(sizes[text] - rank * BLOCK, BLOCK)
    order = np.argsort(-length, kind="stable")  # at step t the blocks still going come first
    begin, length, first = begin[order], length[order], (rank == 0)[order]
    going = [int(np.searchsorted(-length, -t, "left")) for t in range(int(length.max()))]

    product = np.broadcast_to(np.eye(count), (len(begin), count, count)).copy()
    for t, n in enumerate(going):
        here = kinds[codes[begin[:n] + t]][:, None, :]
        step = (product[:n].reshape(-1, count) @ moves).reshape(-1, count, count)
        if t == 0:
            step[first] = 1.0
        product[:n] = _normed(step * here)

    where = np.empty(len(order), dtype=np.int64)
    where[order] = np.arange(len(order))  # block of text i, rank r, in sorted order
    text_first = np.cumsum(per) - per
    enter = np.full((len(begin), count), 1.0 / count)
    leave = np.ones((len(begin), count))
    by_size = np.argsort(-per, kind="stable")
    for r in range(1, int(per.max())):
        n = int(np.searchsorted(-per[by_size], -r, "left"))
        now = text_first[by_size[:n]] + r
        enter[where[now]] = _normed(np.einsum("bi,bij->bj", enter[where[now - 1]], product[where[now - 1]]))
    for r in range(int(per.max()) - 1, 0, -1):
        n = int(np.searchsorted(-per[by_size], -r, "left"))
        now = text_first[by_size[:n]] + r
        leave[where[now - 1]] = _normed(np.einsum("bij,bj->bi", product[where[now]], leave[where[now]]))

    out = np.empty((len(codes), count))
    state = enter
    for t, n in enumerate(going):
        moved = state[:n] @ moves
        if t == 0:
            moved[first] = 1.0
        state = _normed(moved * kinds[codes[begin[:n] + t]])
        out[begin[:n] + t] = state
    back = leave
    for t in range(len(going) - 1, -1, -1):
        n = going[t]
        at = begin[:n] + t
        out[at] *= back[:n]
        back = back.copy()
        back[:n] = _normed((back[:n] * kinds[codes[at]]) @ moves.T)
    return _normed(out)


def fit(sample: list[tuple[str, str]], seed: int = 7) -> Crf:
    """A model of the labelled texts ``(text, label)``; the same sample gives the same model."""
    sample = sorted((words, label) for text, label in sample if (words := _spelled(words_of(text))))
    labels = sorted({label for _, label in sample})
    model = Crf(labels, np.zeros(((1 << HASH_BITS) + len(labels) + 1, len(labels))), np.zeros((len(labels),) * 2))
    if len(labels) < 2:
        return model
    number = {label: i for i, label in enumerate(labels)}
    model.lexicon = _lexicon(sample, number)
    words, golds = _sequences(sample, number, random.Random(seed))
    codes, kinds = pd.factorize(np.array(words, dtype=object).ravel())
    codes, gold = codes.reshape(-1, SEQUENCE), np.array(golds)
    ids, begin = model.features(list(kinds))
    sizes = np.diff(np.append(begin, len(ids)))
    seen_w, seen_m = np.full_like(model.weights, 1e-8), np.full_like(model.moves, 1e-8)
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for part in np.array_split(rng.permutation(len(codes)), max(1, len(codes) // MINIBATCH)):
            own, local = np.unique(codes[part], return_inverse=True)
            local = local.reshape(codes[part].shape)
            mine = np.concatenate([ids[begin[k] : begin[k] + sizes[k]] for k in own])
            starts = np.cumsum(sizes[own]) - sizes[own]
            scores = np.add.reduceat(model.weights[mine], starts, axis=0)
            word_grad, move_grad = _gradient(scores[local], gold[part], model.moves)
            per_kind = np.zeros_like(scores)
            np.add.at(per_kind, local.ravel(), word_grad.reshape(-1, len(labels)))
            spread = np.repeat(per_kind, sizes[own], axis=0)
            touched, slot = np.unique(mine, return_inverse=True)
            grad = np.stack([np.bincount(slot, spread[:, j], len(touched)) for j in range(len(labels))], axis=1)
            grad = grad / len(part) - DECAY * model.weights[touched]
            seen_w[touched] += grad**2
            model.weights[touched] += RATE * grad / np.sqrt(seen_w[touched])
            move_grad = move_grad / len(part) - DECAY * model.moves
            seen_m += move_grad**2
            model.moves += RATE * move_grad / np.sqrt(seen_m)
    model.weights = model.weights.astype(np.float32)  # at most some 33 MB to hand out
    return model


def _gradient(scores: np.ndarray, gold: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the sequences hold less what the model expects, for words and for moves."""
    count = moves.shape[0]
    here = np.exp(scores - scores.max(axis=2, keepdims=True))
    step = np.exp(moves)
    ahead, back = np.empty_like(here), np.ones_like(here)
    ahead[:, 0] = _normed(here[:, 0])
    for t in range(1, here.shape[1]):
        ahead[:, t] = _normed((ahead[:, t - 1] @ step) * here[:, t])
    for t in range(here.shape[1] - 2, -1, -1):
        back[:, t] = _normed((back[:, t + 1] * here[:, t + 1]) @ step.T)
    state = ahead * back
    state /= state.sum(axis=2, keepdims=True)
    pairs = ahead[:, :-1, :, None] * step * (here * back)[:, 1:, None, :]
    pairs /= pairs.sum(axis=(2, 3), keepdims=True)
    held = np.bincount((gold[:, :-1] * count + gold[:, 1:]).ravel(), minlength=count * count)
    return np.eye(count)[gold] - state, held.reshape(count, count) - pairs.sum(axis=(0, 1))


def _lexicon(sample: list[tuple[list[str], str]], number: dict[str, int]) -> dict[str, int]:
    """Words of the sample that belong to one language by a large share of their uses."""
    counts: dict[str, np.ndarray] = {}
    for words, label in sample:
        for word in words:
            counts.setdefault(word.lower(), np.zeros(len(number)))[number[label]] += 1
    return {
        word: int(n.argmax())
        for word, n in counts.items()
        if n.sum() >= LEXICON_COUNT and n.max() >= LEXICON_SHARE * n.sum()
    }


def _sequences(sample, number: dict[str, int], rng: random.Random) -> tuple[list, list]:
    """Sequences of ``SEQUENCE`` words, spliced from stretches of random languages."""
    by_label: dict[str, list[list[str]]] = {}
    for words, label in sample:
        by_label.setdefault(label, []).append(words)
    names = sorted(by_label)
    total = sum(len(words) for words, _ in sample)
    words_out, golds = [], []
    for _ in range(max(MINIBATCH, total // SEQUENCE)):
        words, gold = [], []
        while len(words) < SEQUENCE:
            label = rng.choice(names)
            text = rng.choice(by_label[label])
            size = rng.randint(*STRETCH)
            start = rng.randint(0, max(0, len(text) - size))
            words += text[start : start + size]
            gold += [number[label]] * len(text[start : start + size])
        words_out.append(words[:SEQUENCE])
        golds.append(gold[:SEQUENCE])
    return words_out, golds


def _spelled(words: list[str]) -> list[str]:
    """Words with a letter; digits of other scripts and the like are none."""
    return [w for w in words if w.isalpha() or any(map(str.isalpha, w))]


def is_held_out(key: str = "doc_id") -> Column:
    """Rows that no model may learn from; rows without a key are neither."""
    remainder = F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(HELD_OUT_OF))
    return F.coalesce(remainder == 0, F.lit(False))


def training_sample(docs: DataFrame, key: str = "doc_id") -> list[tuple[str, str]]:
    """About ``DOCS_PER_LANGUAGE`` stretches of text of every language, by a hash of key and text.

    Rows equal in both count once, and twice that number is the most that one language brings to
    the driver, whatever repeats. Every label is learned; more than ``MOST_LABELS`` are an error.
    """
    usable = docs.where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col(key).isNotNull() & ~is_held_out(key)
    )
    counts = usable.groupBy("lang").count().limit(MOST_LABELS + 1).collect()
    if len(counts) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} different labels")
    if not counts:
        return []
    draw = F.xxhash64(F.lit("crf sample"), F.col(key), F.col("text"))
    chosen = F.lit(False)
    for row in counts:
        below = int(2**63 * (min(1.0, DOCS_PER_LANGUAGE / row["count"]) * 2 - 1))
        fits = draw < below if row["count"] > DOCS_PER_LANGUAGE else F.lit(True)
        chosen = F.when(F.col("lang") == row.lang, fits).otherwise(chosen)
    room = F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0)) + 1
    piece = F.substr("text", (F.pmod(draw, room) + 1).cast("int"), F.lit(SAMPLE_CHARS))
    drawn = usable.where(chosen).select(piece.alias("piece"), "lang", draw.alias("draw"))
    drawn = drawn.dropDuplicates(["lang", "draw"])
    first = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    rows = drawn.withColumn("nth", first).where(F.col("nth") <= 2 * DOCS_PER_LANGUAGE).collect()
    return [(row.piece, row.lang) for row in rows]


PREDICTED = "lang_pred string, score double, sure double"


def _predictor(shared):
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for texts in batches:
            words = [_spelled(words_of(text)) for text in texts]
            shares, sure = model.read(words)
            known = np.array([bool(w) for w in words], dtype=bool) & bool(model.labels)
            best = shares.argmax(axis=1) if model.labels else np.zeros(len(words), dtype=int)
            score = shares.max(axis=1, initial=0.0).clip(0.0, 1.0)
            names = [model.labels[b] if k else UNKNOWN for b, k in zip(best, known)]
            sure = np.where(known, sure, 0.0).clip(0.0, 1.0)
            yield pd.DataFrame({"lang_pred": names, "score": np.where(known, score, 0.0), "sure": sure})

    return F.pandas_udf(predict, PREDICTED)


def with_language(docs: DataFrame, model: Crf, into: str, text: str = "text") -> DataFrame:
    """``docs`` with a struct column ``into``: ``lang_pred``, ``score``, the label's share of words,
    and ``sure``, how sure the words are of their own labels.

    Null texts and texts without a letter are ``und`` with score zero, as is every text under a
    model that learned nothing. Ties go to the first label in order. Only the text is read.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.withColumn(into, _predictor(shared)(F.col(text)))


def judge(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per document: ``held_out``, ``lang_pred``, ``score``."""
    model = fit(training_sample(docs, key))
    rows = docs.select(key, is_held_out(key).alias("held_out"), "text")
    found = with_language(rows, model, "found")
    return found.select(key, "held_out", "found.lang_pred", "found.score", "found.sure")


def known_only(docs: DataFrame, least: float = 0.4, key: str = "doc_id") -> DataFrame:
    """``docs`` whose words are sure of a learned language, each of its own, to ``least`` on average.

    A text that switches between languages stays, however many they are.
    """
    into = free_name(docs, "_language")
    found = with_language(docs, fit(training_sample(docs, key)), into)
    clear = (F.col(into)["lang_pred"] != UNKNOWN) & (F.col(into)["sure"] >= least)
    return found.where(clear).drop(into)
