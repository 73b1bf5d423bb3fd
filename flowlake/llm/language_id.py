"""Language identification by a bidirectional gated recurrent network over bytes.

Training (numpy, backpropagation through time, Adam) uses a bounded sample of
labelled snippets; every position of a snippet is labelled with its language.
Prediction reads whole texts: the bytes are cut into windows of ``CORE``
positions with ``MARGIN`` bytes of context on either side, the network labels
every position of every window, and a document's probabilities are the mean
over all its positions.  Windows of many documents run side by side in one
batch, ordered by length, so time per byte does not depend on text length.

The network's input layer is a table by byte, so a step costs one gather, one
small product and the gates.  Parameters are a few kilobytes and travel with
the task.

Defined results: a null text or one without a letter is ``und`` with score 0;
so is every text when no labelled text was learned; with one language learned
every other text gets it with score 1; ties go to the first language in
alphabetical order.  Rows are independent, so repeated rows and null ids
change nothing; extra columns are ignored or kept, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Documented bounds of the training sample: snippets per language, snippets in all, characters of a snippet.
PER_LANGUAGE, MAX_SNIPPETS, SNIPPET = 600, 8192, 160

#: Network and training: units per direction, bytes per training window, windows per step, steps (of each language), seed.
UNITS, TRAIN_BYTES, BATCH, STEPS, SEED = 8, 64, 96, 350, 7

#: Prediction: positions per window, context on either side, windows per batch.
CORE, MARGIN, LANES = 256, 16, 2048
PAD = 256

UNKNOWN = "und"


def sample(df: DataFrame, text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE,
           max_snippets: int = MAX_SNIPPETS) -> list[tuple[str, str]]:
    """At most ``max_snippets`` (language, snippet) rows, about ``per_language`` of each language.

    A text is in or out by a hash of itself, at a rate set by its language's
    number of different texts; equal snippets count once, so copies do not crowd
    out the rest. Where all do not fit, languages get equal numbers. Of more than
    ``max_snippets`` languages those with most different texts are learned.
    """
    t = F.col(text)
    rows = df.select(F.col(lang).alias("lang"), t.alias("t")).filter("lang is not null").filter(t.rlike(r"\p{L}"))
    # no more languages than snippets: at most max_snippets short rows are broadcast, texts stay where they are
    h = F.xxhash64("t")
    counts = rows.select("lang", h.alias("h")).distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.orderBy(F.desc("n"), "lang").limit(max_snippets)
    rows = rows.join(F.broadcast(counts), "lang")
    rows = rows.filter(F.pmod(h, F.lit(1 << 20)) * F.col("n") < F.lit(per_language) * F.lit(1 << 20))
    start = F.pmod(F.shiftright(h, 24), F.greatest(F.length("t") - SNIPPET, F.lit(0)) + 1) + 1
    snippets = rows.select("lang", F.substr("t", start.cast("int"), F.lit(SNIPPET)).alias("s")).distinct()
    # about per_language rows to a window
    turn = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("s"), "s"))
    taken = snippets.select("lang", "s", F.xxhash64("s").alias("h"), turn.alias("turn")).orderBy(
        "turn", "h", "s", "lang").limit(max_snippets).collect()
    return [(r.lang, r.s) for r in sorted(taken, key=lambda r: (r.h, r.s, r.lang))]


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


def train(snippets: list[tuple[str, str]], units: int = UNITS, steps: int = STEPS, seed: int = SEED) -> dict | None:
    """Parameters learned from (language, snippet) rows; None without any."""
    langs = sorted({x for x, _ in snippets})
    if not langs:
        return None
    rng, h, k = np.random.default_rng(seed), units, len(langs)
    # leading axis: direction; columns of tables and recurrences: reset, update, new
    p = {
        "table": rng.normal(0, 0.3, (2, 257, 3 * h)),
        "rec": rng.normal(0, 1 / np.sqrt(h), (2, h, 3 * h)),
        "rec_bias": np.zeros((2, 1, 3 * h)),
        "out": rng.normal(0, 0.3, (2, h, k)),
        "out_bias": np.zeros(k),
    }
    # padding keeps the state as it is (update gate open, never learned), so that a text's
    # probabilities do not depend on how far its window is padded
    p["table"][:, PAD] = 0
    p["table"][:, PAD, h:2 * h] = 30
    if k == 1:
        return {"langs": langs}
    texts = [np.frombuffer(s.encode(), np.uint8) for _, s in snippets]
    label = np.array([langs.index(x) for x, _ in snippets])
    by_lang = [np.flatnonzero(label == i) for i in range(k)]
    m = {n: np.zeros_like(v) for n, v in p.items()}
    s = {n: np.zeros_like(v) for n, v in p.items()}
    steps = -(-steps * max(k, BATCH) // BATCH)  # languages take turns over the steps, each as often as in a full batch
    for step in range(1, steps + 1):
        pick = np.array([rng.choice(by_lang[((step - 1) * BATCH + i) % k]) for i in range(BATCH)])
        x = np.full((BATCH, TRAIN_BYTES), PAD, np.int64)
        for row, i in enumerate(pick):
            t = texts[i]
            size = TRAIN_BYTES if row % 2 else rng.integers(8, TRAIN_BYTES + 1)  # short texts occur too
            at = rng.integers(0, max(1, len(t) - size + 1))
            t = t[at: at + size]
            x[row, : len(t)] = t
        grad = _gradients(p, x, label[pick])
        rate = 0.02 * min(1.0, 2 * (1 - step / (steps + 1)))
        for n, g in grad.items():
            m[n] = 0.9 * m[n] + 0.1 * g
            s[n] = 0.99 * s[n] + 0.01 * g * g
            p[n] -= rate * (m[n] / (1 - 0.9 ** step)) / (np.sqrt(s[n] / (1 - 0.99 ** step)) + 1e-8)
    return {"langs": langs} | p


def _gradients(p: dict, x: np.ndarray, y: np.ndarray) -> dict:
    """Gradients of the mean position loss, back through time in both directions."""
    b, n = x.shape
    h = p["rec"].shape[1]
    both = np.stack([x, x[:, ::-1]])  # direction 1 reads backwards
    inputs = np.stack([p["table"][d][both[d]] for d in (0, 1)])  # 2, b, n, 3h
    state, kept, states = np.zeros((2, b, h)), [], np.empty((2, b, n, h))
    for t in range(n):
        g = state @ p["rec"] + p["rec_bias"]
        r = _sigmoid(inputs[:, :, t, :h] + g[..., :h])
        z = _sigmoid(inputs[:, :, t, h:2 * h] + g[..., h:2 * h])
        c = np.tanh(inputs[:, :, t, 2 * h:] + r * g[..., 2 * h:])
        kept.append((state, r, z, c, g[..., 2 * h:]))
        state = c + z * (state - c)
        states[:, :, t] = state
    aligned = np.stack([states[0], states[1][:, ::-1]])
    logits = sum(aligned[d] @ p["out"][d] for d in (0, 1)) + p["out_bias"]
    e = np.exp(logits - logits.max(-1, keepdims=True))
    delta = e / e.sum(-1, keepdims=True)
    delta[np.arange(b)[:, None], np.arange(n)[None, :], y[:, None]] -= 1
    delta *= (x != PAD)[..., None] / max(1, (x != PAD).sum())
    out = {"out": np.stack([np.einsum("bnh,bnk->hk", aligned[d], delta) for d in (0, 1)]),
           "out_bias": delta.sum((0, 1)), "rec": np.zeros_like(p["rec"]), "rec_bias": np.zeros_like(p["rec_bias"])}
    into = np.stack([delta @ p["out"][0].T, (delta @ p["out"][1].T)[:, ::-1]])
    at_input, back = np.empty_like(inputs), np.zeros((2, b, h))
    for t in range(n - 1, -1, -1):
        before, r, z, c, gn = kept[t]
        back = back + into[:, :, t]
        dc = back * (1 - z) * (1 - c * c)
        dz = back * (before - c) * z * (1 - z)
        dr = dc * gn * r * (1 - r)
        at_input[:, :, t] = np.concatenate([dr, dz, dc], -1)
        dg = np.concatenate([dr, dz, dc * r], -1)
        out["rec"] += before.transpose(0, 2, 1) @ dg
        out["rec_bias"] += dg.sum(1, keepdims=True)
        back = back * z + dg @ p["rec"].transpose(0, 2, 1)
    out["table"] = np.zeros_like(p["table"])
    for d in (0, 1):
        np.add.at(out["table"][d], both[d].ravel(), at_input[d].reshape(-1, 3 * h))
    out["table"][:, PAD] = 0
    return out


class Reader:
    """Runs learned parameters over many texts; float32, features by lanes.

    Halves of the gate arithmetic are folded into the weights: a gate is
    0.5 + 0.5 tanh(a / 2).
    """

    def __init__(self, model: dict):
        self.langs = model["langs"]
        if len(self.langs) < 2:
            return
        h = model["rec"].shape[1]
        half = np.ones(3 * h)
        half[: 2 * h] = 0.5
        rec_half = np.full(3 * h, 0.5)  # the new gate's recurrent part is used as 0.5 g + 0.5 tanh(a/2) g
        f = lambda a: np.ascontiguousarray(a, dtype=np.float32)
        bias = model["rec_bias"][:, 0] * np.concatenate([np.ones(2 * h), np.zeros(h)])
        self.table = [f(((model["table"][d] + bias[d]) * half).T) for d in (0, 1)]
        self.rec = [f((model["rec"][d] * rec_half).T) for d in (0, 1)]
        self.new_bias = [f(model["rec_bias"][d, 0, 2 * h:, None] * 0.5) for d in (0, 1)]
        self.out = [f(model["out"][d].T) for d in (0, 1)]
        self.out_bias = f(model["out_bias"][:, None])
        self.h = h

    def _step(self, d: int, state: np.ndarray, x: np.ndarray) -> np.ndarray:
        h = self.h
        a = np.take(self.table[d], x, axis=1, mode="clip")
        g = self.rec[d] @ state
        gates = a[: 2 * h]
        gates += g[: 2 * h]
        np.tanh(gates, out=gates)
        r, z, gn, c = gates[:h], gates[h:], g[2 * h:], a[2 * h:]
        gn += self.new_bias[d]
        c += gn
        gn *= r
        c += gn
        np.tanh(c, out=c)
        diff = state - c
        diff *= z
        diff += state
        diff += c
        diff *= 0.5
        return diff

    def _lanes(self, x: np.ndarray, core: np.ndarray) -> np.ndarray:
        """Sums of position probabilities (languages by lanes); x: positions by lanes, core: mask of the same."""
        n, b = x.shape
        states, state = np.empty((n, self.h, b), np.float32), np.zeros((self.h, b), np.float32)
        for t in range(n):
            state = self._step(0, state, x[t])
            states[t] = state
        state, total = np.zeros((self.h, b), np.float32), np.zeros((len(self.langs), b))
        for t in range(n - 1, -1, -1):
            state = self._step(1, state, x[t])
            if core[t].any():
                e = self.out[0] @ states[t]
                e += self.out[1] @ state
                e += self.out_bias
                e -= e.max(axis=0)
                np.exp(e, out=e)
                e *= core[t] / e.sum(axis=0)
                total += e
        return total

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        """Mean position probabilities, texts by languages; every text has a byte at least."""
        sizes = np.array([len(t) for t in texts], np.int64)
        if len(self.langs) < 2:
            return np.ones((len(texts), 1))
        flat = np.frombuffer(b"".join(texts), np.uint8).astype(np.int16)  # PAD does not fit a byte
        first = np.cumsum(sizes) - sizes
        n_windows = -(-sizes // CORE)
        doc = np.repeat(np.arange(len(texts)), n_windows)
        k = np.arange(len(doc)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
        begin = k * CORE  # of the core, within its text
        length = np.minimum(CORE, sizes[doc] - begin)
        sums = np.zeros((len(texts), len(self.langs)))
        order = np.argsort(length, kind="stable")
        for at in range(0, len(order), LANES):
            w = order[at: at + LANES]
            n = int(length[w].max()) + 2 * MARGIN
            rel = begin[w][None, :] - MARGIN + np.arange(n)[:, None]
            inside = (rel >= 0) & (rel < sizes[doc[w]][None, :])
            where = np.where(inside, rel + first[doc[w]][None, :], 0)
            x = np.where(inside, flat[where], PAD).astype(np.intp)
            step = np.arange(n)[:, None]
            core = ((step >= MARGIN) & (step < MARGIN + length[w][None, :])).astype(np.float32)
            got = self._lanes(x, core)
            for lang in range(len(self.langs)):
                sums[:, lang] += np.bincount(doc[w], got[lang], len(texts))
        return sums / sums.sum(axis=1, keepdims=True)


def predict(text: Column, model: dict | None) -> Column:
    """struct<lang:string, score:double> of each whole text."""

    def batches(parts):
        reader = Reader(model) if model else None
        for texts in parts:
            lang, score = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
            at = [i for i, t in enumerate(texts) if t] if reader else []
            # bounded groups of texts, so that a batch of very long ones needs no more memory
            group, size = [], 0
            for n, i in enumerate(at):
                group.append(i)
                size += len(texts.iloc[i])
                if size >= 4 << 20 or n == len(at) - 1:
                    p = reader.probabilities([texts.iloc[j].encode() for j in group])
                    best = p.argmax(axis=1)
                    lang[group] = np.array(reader.langs, object)[best]
                    score[group] = np.clip(p[np.arange(len(group)), best], 0.0, 1.0)
                    group, size = [], 0
            yield pd.DataFrame({"lang": lang, "score": score})

    # evaluated as Iterator[pd.Series] -> Iterator[pd.DataFrame]: one reader a task
    from collections.abc import Iterator

    batches.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(batches, "lang string, score double")(F.when(text.rlike(r"\p{L}"), text))


def learn(df: DataFrame, text: str = "text", lang: str = "lang") -> dict | None:
    """Sample labelled rows and train."""
    return train(sample(df, text, lang))


def identify(df: DataFrame, model: dict | None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, lang_pred, score."""
    out = df.select(F.col(id_col).alias("id"), predict(F.col(text), model).alias("p"))
    return out.select(F.col("id").alias(id_col), F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def least_score(model: dict | None) -> float:
    """The score that tells a language from the others: 0.4, with more than four languages 1.6 times chance."""
    return min(0.4, 1.6 / max(1, len(model["langs"]))) if model else 0.4


def keep_known(df: DataFrame, model: dict | None, text: str = "text", min_score: float | None = None) -> DataFrame:
    """The rows of ``df`` whose language is told with at least ``min_score`` (``least_score`` of the model)."""
    min_score = least_score(model) if min_score is None else min_score
    row = F.struct(*(F.col(f"`{c}`") for c in df.columns))
    out = df.select(row.alias("row"), predict(F.col(text), model).alias("p"))
    return out.filter((F.col("p.lang") != UNKNOWN) & (F.col("p.score") >= min_score)).select("row.*")
