"""Language identification: a bidirectional gated recurrent network over bytes labels every position."""

from __future__ import annotations

from functools import reduce
from operator import or_

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.common import chosen_share, map_rows, replaced

#: Bytes labelled in a pass of the network, and bytes before and behind them that it reads along with them.
STRETCH, AROUND = 128, 8
HIDDEN = 8
#: The network is fitted on at most this many documents of each language, and of each on this many characters at most,
#: beginning at a place that the hash of its id chooses.
MAX_PER_LANG, MAX_CHARS = 400, 2000
#: Passes over the sampled stretches, at least so many steps.
EPOCHS, LEAST_STEPS, BATCH, RATE = 1, 150, 128, 0.02
SEED = 42
#: Stretches worked on at a time.
WIDE = 2048
UNKNOWN = "und"


class ByteNetwork:
    """Two gated recurrent layers, one per direction, and a softmax at every byte.

    ``x`` holds each byte's contribution to the gates, ``u`` the state's; gates are update, reset and candidate.
    Arrays over time are time, direction, stretch, unit; the second direction reads backwards.
    """

    def __init__(self, classes: int, hidden: int = HIDDEN, seed: int = SEED):
        rng = np.random.default_rng(seed)
        h = hidden
        self.h, self.classes = h, classes
        self.p = {
            "x": rng.normal(0, 0.3, (2, 256, 3 * h)), "u": rng.normal(0, h**-0.5, (2, h, 3 * h)),
            "w": rng.normal(0, (2 * h) ** -0.5, (2, h, classes)), "b": np.zeros(classes),
        }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def states(self, codes: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States after each byte; where ``mask`` is 0 the state is zero. ``keep`` gets what the way back needs."""
        n, length = codes.shape
        h, x, u = self.h, self.p["x"], self.p["u"]
        by_time = np.ascontiguousarray(codes.T)
        there = np.ascontiguousarray(mask.T).astype(x.dtype)
        whole = there.all(axis=1)
        state = np.zeros((2, n, h), np.float32)
        out = np.empty((length, 2, n, h), np.float32)
        a = np.empty((2, n, 3 * h), x.dtype)
        for t in range(length):
            back = length - 1 - t
            np.take(x[0], by_time[t], axis=0, out=a[0], mode="clip")
            np.take(x[1], by_time[back], axis=0, out=a[1], mode="clip")
            on = np.stack((there[t], there[back]))[..., None]
            s = np.matmul(state, u)
            gate = a[..., : 2 * h] + s[..., : 2 * h]
            gate *= 0.5
            np.tanh(gate, out=gate)
            gate *= 0.5
            gate += 0.5
            z, r = gate[..., :h], gate[..., h:]
            c = r * s[..., 2 * h :]
            c += a[..., 2 * h :]
            np.tanh(c, out=c)
            new = state - c
            new *= z
            new += c
            if not (whole[t] and whole[back]):
                new *= on
            if keep is not None:
                keep.append((state, z, r, c, s[..., 2 * h :], on))
            out[t] = state = new
        return out

    def probabilities(self, states: np.ndarray) -> np.ndarray:
        """Stretch, position, class."""
        logits = np.matmul(states[:, 0], self.p["w"][0]) + np.matmul(states[::-1, 1], self.p["w"][1]) + self.p["b"]
        logits -= logits.max(axis=-1, keepdims=True)
        e = np.exp(logits)
        return (e / e.sum(axis=-1, keepdims=True)).transpose(1, 0, 2)

    def gradients(self, codes: np.ndarray, mask: np.ndarray, label: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Log loss over all labelled positions and its gradients, back through time in both directions."""
        n, length = codes.shape
        h, keep = self.h, []
        states = self.states(codes, mask, keep)
        prob = self.probabilities(states)
        weight = (mask / max(1, mask.sum())).astype(np.float32)
        loss = -float((np.log(np.maximum(prob[np.arange(n), :, label], 1e-9)) * weight).sum())
        d = prob.copy()
        d[np.arange(n), :, label] -= 1
        d = (d * weight[..., None]).transpose(1, 0, 2)
        dw = np.stack([np.einsum("tnh,tnc->hc", states[:, 0], d), np.einsum("tnh,tnc->hc", states[::-1, 1], d)])
        ds = np.stack((np.matmul(d, self.p["w"][0].T), np.matmul(d[::-1], self.p["w"][1].T)), axis=1)
        du = np.zeros_like(self.p["u"])
        dx = np.empty((length, 2, n, 3 * h), np.float32)
        back = np.zeros((2, n, h), np.float32)
        turned = self.p["u"].transpose(0, 2, 1)
        for t in range(length - 1, -1, -1):
            before, z, r, c, sc, on = keep[t]
            g = (ds[t] + back) * on
            gc = g * (1 - z) * (1 - c * c)
            gz = g * (before - c) * z * (1 - z)
            gr = gc * sc * r * (1 - r)
            dx[t] = np.concatenate((gz, gr, gc), axis=-1)
            gs = np.concatenate((gz, gr, gc * r), axis=-1)
            du += np.matmul(before.transpose(0, 2, 1), gs)
            back = g * z + np.matmul(gs, turned)
        one = np.zeros((n * length, 256), np.float32)
        one[np.arange(n * length), codes.T.ravel()] = 1
        table = np.stack((one.T @ dx[:, 0].reshape(-1, 3 * h), one.T @ dx[::-1, 1].reshape(-1, 3 * h)))
        return loss, {"x": table, "u": du, "w": dw.astype(np.float32), "b": d.sum(axis=(0, 1))}

    def fit(self, codes: np.ndarray, mask: np.ndarray, label: np.ndarray, steps: int | None = None) -> None:
        """Adam on batches with as many stretches of each language as of any other; more stretches take more steps."""
        steps = steps or max(LEAST_STEPS, -(-EPOCHS * len(codes) // BATCH))
        rng = np.random.default_rng(SEED)
        by = [np.flatnonzero(label == c) for c in range(self.classes)]
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        for t in range(1, steps + 1):
            pick = np.array([rng.choice(by[c]) for c in rng.integers(0, self.classes, BATCH)])
            rate = RATE * min(1.0, 2 * (1 - t / (steps + 1)))
            for k, g in self.gradients(codes[pick], mask[pick], label[pick])[1].items():
                g = np.clip(g, -1, 1)
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                self.p[k] = (self.p[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-8)).astype(np.float32)


def stretches(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of all texts in stretches with what lies around them: codes, where there is a byte, which of them the
    stretch labels (each byte of a text once), and the number of each stretch's text."""
    raw = [(t or "").encode() for t in texts]
    sizes = np.array([len(b) for b in raw], np.int64)
    counts = -(-sizes // STRETCH)
    room = counts * STRETCH + 2 * AROUND
    line = b"".join((bytes(AROUND) + b).ljust(int(n), b"\0") for b, n in zip(raw, room, strict=True))
    owner = np.repeat(np.arange(len(raw)), counts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    place = np.arange(STRETCH + 2 * AROUND)
    starts = (np.cumsum(room) - room)[owner] + nth * STRETCH
    codes = np.frombuffer(line, np.uint8)[starts[:, None] + place]
    at = (nth * STRETCH - AROUND)[:, None] + place
    there = (at >= 0) & (at < sizes[owner][:, None])
    return codes, there, there & (place >= AROUND) & (place < AROUND + STRETCH), owner


def training_rows(docs: DataFrame, learned) -> tuple[list[str], list[str]]:
    """Texts and languages to learn from: per language the first documents by the hash of their id.

    Languages, all of them, are counted; a hash of the id then chooses about twice the documents wanted of each, wherever
    they lie, so what is shuffled does not grow with the table. Rows that repeat an id count once. Of a long text only
    ``MAX_CHARS`` characters are taken.
    """
    some = docs.filter(learned & F.col("lang").isNotNull() & (F.octet_length("text") > 0)).select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    from_here = F.pmod(F.xxhash64(F.lit("place"), "doc_id"), F.greatest(F.length("text") - MAX_CHARS, F.lit(0)) + 1) + 1
    some = some.withColumn("text", F.substr("text", from_here.cast("int"), F.lit(MAX_CHARS)))
    counts = some.groupBy("lang").count().collect()  # a row per language
    if not counts:
        return [], []
    picks = [(F.col("lang") == r["lang"]) & chosen_share(r["count"], MAX_PER_LANG, "doc_id") for r in counts]
    few = some.filter(reduce(or_, picks)).dropDuplicates(["lang", "doc_id"])
    w = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"))
    rows = few.withColumn("_q_n", F.row_number().over(w)).filter(F.col("_q_n") <= MAX_PER_LANG)
    got = rows.select("lang", "_q_n", F.col("text")).collect()
    got.sort(key=lambda r: (r["lang"], r["_q_n"]))
    return [r["text"] for r in got], [r["lang"] for r in got]


def fit_languages(docs: DataFrame, learned) -> tuple[list[str], ByteNetwork | None]:
    texts, said = training_rows(docs, learned)
    langs = sorted(set(said))
    if not langs:
        return [], None
    codes, there, _, owner = stretches(texts)
    network = ByteNetwork(len(langs))
    network.fit(codes, there, np.array([langs.index(x) for x in said])[owner])
    return langs, network


def pooled_languages(texts: list[str | None], langs: list[str], network: ByteNetwork | None) -> list[tuple[str, float]]:
    """Each text's language and probability: the mean over all its positions."""
    codes, there, labelled, owner = stretches(texts)
    sums = np.zeros((len(texts), max(1, len(langs))))
    if network is not None:
        for at in range(0, len(codes), WIDE):
            prob = network.probabilities(network.states(codes[at : at + WIDE], there[at : at + WIDE]))
            np.add.at(sums, owner[at : at + WIDE], np.einsum("nlc,nl->nc", prob, labelled[at : at + WIDE].astype(np.float32)))
    out = []
    for t, row in zip(texts, sums, strict=True):
        if not t or network is None or not any(map(str.isalpha, t)):
            out.append((UNKNOWN, 0.0))
        else:
            best = int(row.argmax())
            out.append((langs[best], min(1.0, float(row[best] / row.sum()))))
    return out


def identify_languages(docs: DataFrame, folds: int = 4, fold: int = 2) -> DataFrame:
    """Add ``held_out, lang_pred, score`` to every document.

    Learned from texts and languages of documents outside the held-out fold; a prediction reads the whole text and
    nothing else. Null texts, texts without a letter, and all texts if there is nothing to learn from, are ``und`` with
    score 0. Rows with a null id are held out; equal rows get equal predictions; an empty table stays empty. Columns
    read: ``doc_id, text, lang``.
    """
    out_fold = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == fold, F.lit(True))
    langs, network = fit_languages(docs, ~out_fold)
    shared = docs.sparkSession.sparkContext.broadcast((langs, network))  # a fixed size, some kilobytes

    def make():
        langs, network = shared.value
        return lambda texts: zip(*pooled_languages(texts, langs, network), strict=True)

    out = map_rows(replaced(docs, ["held_out"]), ["text"], "lang_pred string, score double", make, batch=True)
    return out.withColumn("held_out", out_fold)
