"""A bidirectional gated recurrent network with attention pooling over character and word inputs, in numpy."""

import re
import zlib
from dataclasses import dataclass, field

import numpy as np

#: Buckets and dimensions of word and character n-gram vectors, and units of each direction.
BUCKETS, DIMENSIONS, UNITS = 1 << 17, 4, 8
#: Words of a window, and between the starts of two windows.
WINDOW, STRIDE = 32, 16
#: Lengths of character n-grams of a word between its marks.
GRAMS = (3, 4, 5)
#: Words remembered by a scorer, and windows scored at once.
REMEMBERED, TOGETHER = 500_000, 1024

_WORD = re.compile(r"[^\W_]+")


def tokens(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def word_bucket(word: str) -> int:
    return zlib.crc32(word.encode()) % BUCKETS


def gram_buckets(word: str) -> list[int]:
    """Distinct buckets of the word's character n-grams; at least one."""
    marked = f"<{word}>".encode()
    return list({zlib.crc32(marked[i : i + n], n) % BUCKETS for n in GRAMS for i in range(max(1, len(marked) - n + 1))})


def window_starts(n: int) -> list[int]:
    """Windows overlap by half and cover all ``n`` words; the last ends with them."""
    if n <= WINDOW:
        return [0] if n else []
    return [*range(0, n - WINDOW, STRIDE), n - WINDOW]


def windows(ids: np.ndarray) -> np.ndarray:
    """(windows, WINDOW) ids, -1 beyond the end."""
    padded = np.concatenate([ids, np.full(max(0, WINDOW - len(ids)), -1, np.int64)])
    starts = np.array(window_starts(len(ids)), np.int64)
    return padded[starts[:, None] + np.arange(WINDOW)]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Words:
    """The distinct words of some texts: word buckets and their n-gram buckets, one after another."""

    bucket: np.ndarray
    grams: np.ndarray
    starts: np.ndarray

    @classmethod
    def of(cls, words: list[str]) -> "Words":
        grams = [gram_buckets(w) for w in words]
        starts = np.cumsum([0, *map(len, grams)])
        flat = np.fromiter((g for own in grams for g in own), np.int64, int(starts[-1]))
        return cls(np.array([word_bucket(w) for w in words], np.int64), flat, starts)

    def take(self, which: np.ndarray) -> "Words":
        n = self.starts[which + 1] - self.starts[which]
        starts = np.concatenate([[0], np.cumsum(n)])
        place = np.arange(starts[-1]) - np.repeat(starts[:-1], n) + np.repeat(self.starts[which], n)
        return Words(self.bucket[which], self.grams[place], starts)


@dataclass
class Network:
    """Parameters by name. Gates are in the order update, reset, candidate; directions are stacked."""

    values: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def fresh(cls, seed: int = 0) -> "Network":
        rng = np.random.default_rng(seed)
        d, h = 2 * DIMENSIONS, UNITS
        shapes = {"word": (BUCKETS, DIMENSIONS), "gram": (BUCKETS, DIMENSIONS), "in": (2, d, 3 * h), "bias": (2, 1, 3 * h), "gates": (2, h, 2 * h), "candidate": (2, h, h), "attend": (2 * h, h), "look": (h, 1), "out": (2 * h, 1), "level": (1,)}
        scale = {"word": 0.05, "gram": 0.05, "bias": 0.0, "level": 0.0}
        return cls({k: (rng.standard_normal(s) * scale.get(k, 1 / np.sqrt(s[-2] if len(s) > 1 else 1))).astype(np.float32) for k, s in shapes.items()})

    def inputs(self, words: Words) -> np.ndarray:
        """A row per word: its vector, and the greatest of its n-grams' vectors in each dimension."""
        if not len(words.bucket):
            return np.zeros((0, 2 * DIMENSIONS), np.float32)
        pooled = np.maximum.reduceat(self.values["gram"][words.grams], words.starts[:-1], axis=0)
        return np.concatenate([self.values["word"][words.bucket], pooled], axis=1)

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logits of windows from (WINDOW, n, inputs) and (WINDOW, n); what training needs if ``keep``."""
        v, (steps, n, _) = self.values, x.shape
        h = np.zeros((2, n, UNITS), np.float32)
        joint, kept = np.empty((steps, n, 2 * UNITS), np.float32), []
        full = bool(mask.all())
        for t in range(steps):
            back = steps - 1 - t
            p = np.empty((2, n, 3 * UNITS), np.float32)
            np.matmul(x[t], v["in"][0], out=p[0])
            np.matmul(x[back], v["in"][1], out=p[1])
            p += v["bias"]
            gates = h @ v["gates"]
            gates += p[..., : 2 * UNITS]
            gates *= 0.5
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            update, reset = gates[..., :UNITS], gates[..., UNITS:]
            inner = h @ v["candidate"]
            new = reset * inner
            new += p[..., 2 * UNITS :]
            np.tanh(new, out=new)
            change = new - h
            change *= update
            if not full:
                change *= np.stack([mask[t], mask[back]])[..., None]
            if keep:
                kept.append((h, update, reset, inner, new))
            h = h + change
            joint[t, :, :UNITS] = h[0]
            joint[back, :, UNITS:] = h[1]
        seen = np.tanh(joint @ v["attend"])
        focus = np.where(mask, (seen @ v["look"])[..., 0], np.float32(-1e9))
        focus = np.exp(focus - focus.max(0))
        focus /= focus.sum(0)
        pooled = np.einsum("tn,tni->ni", focus, joint)
        logit = (pooled @ v["out"])[:, 0] + v["level"]
        return (logit, (x, mask, kept, joint, seen, focus, pooled)) if keep else logit

    def backward(self, d_logit: np.ndarray, memory) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of all but the vectors, and of the inputs."""
        v = self.values
        x, mask, kept, joint, seen, focus, pooled = memory
        steps, n, _ = x.shape
        g = {"level": np.array([d_logit.sum()], np.float32), "out": pooled.T @ d_logit[:, None]}
        d_pooled = d_logit[:, None] * v["out"].T
        d_focus = np.einsum("tni,ni->tn", joint, d_pooled)
        d_score = focus * (d_focus - (focus * d_focus).sum(0))
        g["look"] = np.einsum("tnh,tn->h", seen, d_score)[:, None]
        d_seen = d_score[..., None] * v["look"][:, 0] * (1 - seen**2)
        g["attend"] = np.einsum("tni,tnh->ih", joint, d_seen)
        d_joint = focus[..., None] * d_pooled + d_seen @ v["attend"].T
        d_x = np.zeros_like(x)
        g |= {k: np.zeros_like(v[k]) for k in ("gates", "candidate", "in", "bias")}
        d_h = np.zeros((2, n, UNITS), np.float32)
        for t in range(steps - 1, -1, -1):
            back = steps - 1 - t
            h, update, reset, inner, new = kept[t]
            d_h = d_h + np.stack([d_joint[t, :, :UNITS], d_joint[back, :, UNITS:]])
            masked = d_h * np.stack([mask[t], mask[back]])[..., None]
            d_new = masked * update * (1 - new**2)
            d_update = masked * (new - h) * update * (1 - update)
            d_reset = d_new * inner * reset * (1 - reset)
            d_gates = np.concatenate([d_update, d_reset], axis=-1)
            d_inner = d_new * reset
            g["gates"] += h.transpose(0, 2, 1) @ d_gates
            g["candidate"] += h.transpose(0, 2, 1) @ d_inner
            d_p = np.concatenate([d_gates, d_new], axis=-1)
            g["bias"] += d_p.sum(1, keepdims=True)
            for way, at in ((0, t), (1, back)):
                g["in"][way] += x[at].T @ d_p[way]
                d_x[at] += d_p[way] @ v["in"][way].T
            d_h = d_h - masked * update + d_gates @ v["gates"].transpose(0, 2, 1) + d_inner @ v["candidate"].transpose(0, 2, 1)
        return g, d_x

    def backward_vectors(self, words: Words, d_inputs: np.ndarray) -> dict[str, np.ndarray]:
        g = {"word": np.zeros_like(self.values["word"]), "gram": np.zeros_like(self.values["gram"])}
        np.add.at(g["word"], words.bucket, d_inputs[:, :DIMENSIONS])
        n = np.diff(words.starts)
        vectors = self.values["gram"][words.grams]
        most = np.repeat(np.maximum.reduceat(vectors, words.starts[:-1], axis=0), n, axis=0) == vectors
        np.add.at(g["gram"], words.grams, most * np.repeat(d_inputs[:, DIMENSIONS:], n, axis=0))
        return g


class Adam:
    def __init__(self, network: Network, rate: float) -> None:
        self.network, self.rate, self.steps = network, rate, 0
        self.first = {k: np.zeros_like(v) for k, v in network.values.items()}
        self.second = {k: np.zeros_like(v) for k, v in network.values.items()}

    def step(self, gradients: dict[str, np.ndarray]) -> None:
        self.steps += 1
        rate = self.rate * np.sqrt(1 - 0.999**self.steps) / (1 - 0.9**self.steps)
        for k, g in gradients.items():
            vectors = k in ("word", "gram")
            rows = np.flatnonzero(g.any(1)) if vectors else slice(None)  # vectors in use
            g = g[rows]
            self.first[k][rows] = m = 0.9 * self.first[k][rows] + 0.1 * g
            self.second[k][rows] = s = 0.999 * self.second[k][rows] + 0.001 * g * g
            self.network.values[k][rows] -= (rate * (0.1 if vectors else 1) * m / (np.sqrt(s) + 1e-8)).astype(np.float32)


def _odds(own: list[np.ndarray], label: np.ndarray, prior: float) -> np.ndarray:
    """Log-odds of label 1 by bucket, from the texts that hold it, shrunk by ``prior`` texts."""
    held, toxic = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for buckets, y in zip(own, label, strict=True):
        held[buckets] += 1
        toxic[buckets] += y
    rate = min(max(label.mean(), 1e-3), 1 - 1e-3)
    return np.log((toxic + prior * rate) / (held - toxic + prior * (1 - rate))) - np.log(rate / (1 - rate))


def train(texts: list[str | None], labels: list[int], steps: int = 250, batch: int = 256, rate: float = 0.01, seed: int = 0) -> Network:
    """Fits on texts with labels 0 and 1, of which a text's most toxic window answers for it.

    Vectors start from the log-odds of their bucket in the first dimension. Each epoch takes the highest
    window of every text by the network so far (at first by those log-odds), and of texts with label 0 one
    at random. Few texts take more epochs, so that there are ``steps`` updates; the rate falls.
    """
    network, rng = Network.fresh(seed), np.random.default_rng(seed)
    y = np.array(labels, np.float32)
    split = [tokens(x) for x in texts]
    number: dict[str, int] = {}
    ids = [np.array([number.setdefault(w, len(number)) for w in s], np.int64) for s in split]
    if not number or not 0 < y.sum() < len(y):
        network.values["level"][:] = -20.0 if not y.sum() else 20.0
        network.values["out"][:] = 0
        return network
    words = Words.of(list(number))
    distinct = [np.unique(i) for i in ids]
    network.values["word"][:, 0] += _odds([np.unique(words.bucket[i]) for i in distinct], y, 5.0)
    network.values["gram"][:, 0] += _odds([np.unique(words.take(i).grams) for i in distinct], y, 5.0)
    cut = [windows(i) for i in ids]
    text = np.repeat(np.arange(len(cut)), [len(c) for c in cut])
    every = np.concatenate(cut)
    first = np.searchsorted(text, np.arange(len(cut)))
    used = np.flatnonzero(np.bincount(text, minlength=len(cut)))
    optimiser = Adam(network, rate)
    share = y[used].mean()
    weight = np.where(y > 0, 0.5 / share, 0.5 / (1 - share)) ** 0.5  # halfway to even classes
    epochs = -(-steps // max(1, round((1 + float((y[used] == 0).mean())) * len(used) / batch)))
    for epoch in range(epochs):
        optimiser.rate = rate * (1 - 0.9 * epoch / epochs)
        chosen = first[used] + rng.integers(0, np.bincount(text, minlength=len(cut))[used])
        table = np.concatenate([network.inputs(words), np.zeros((1, 2 * DIMENSIONS), np.float32)])
        if not epoch:
            scores = (table[:, 0] + table[:, DIMENSIONS])[every].max(1)
        else:
            scores = np.concatenate([network.forward(table[w.T], w.T >= 0) for w in np.array_split(every, -(-len(every) // TOGETHER))])
        top = np.lexsort((-scores, text))[first[used]]
        chosen = np.concatenate([top, chosen[y[used] == 0]])  # a random window of a toxic text may be clean
        for part in np.array_split(rng.permutation(chosen), -(-len(chosen) // batch)):
            cells = every[part].T
            own, place = np.unique(cells, return_inverse=True)
            place = place.reshape(cells.shape)
            pad = int(own[0] < 0)
            held = words.take(own[pad:])
            table = np.concatenate([np.zeros((pad, 2 * DIMENSIONS), np.float32), network.inputs(held)])
            logit, memory = network.forward(table[place], cells >= 0, keep=True)
            d_logit = ((sigmoid(logit) - y[text[part]]) * weight[text[part]] / len(part)).astype(np.float32)
            gradients, d_x = network.backward(d_logit, memory)
            d_table = np.zeros_like(table)
            np.add.at(d_table, place.reshape(-1), d_x.reshape(-1, d_x.shape[-1]))
            optimiser.step(gradients | network.backward_vectors(held, d_table[pad:]))
    return network


class Scorer:
    """Scores whole texts: the highest of all windows' probabilities, 0 without words."""

    def __init__(self, network: Network) -> None:
        self.network = network
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.table = np.zeros((1024, 2 * DIMENSIONS), np.float32)

    def _ids(self, split: list[list[str]]) -> list[np.ndarray]:
        new = set().union(*split) - self.number.keys()
        if len(self.number) + len(new) > REMEMBERED:
            self._forget()
            new = set().union(*split)
        fresh = list(new)
        n = len(self.number)
        if n + len(fresh) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros((n + len(fresh), 2 * DIMENSIONS), np.float32)])
        self.table[n : n + len(fresh)] = self.network.inputs(Words.of(fresh))
        self.number.update(zip(fresh, range(n, n + len(fresh)), strict=True))
        get = self.number.__getitem__
        return [np.fromiter(map(get, s), np.int64, len(s)) for s in split]

    def scores(self, texts: list[str | None]) -> np.ndarray:
        cut = [windows(i) for i in self._ids([tokens(x) for x in texts])]
        text = np.repeat(np.arange(len(cut)), [len(c) for c in cut])
        every = np.concatenate(cut)
        best = np.full(len(texts), -np.inf)
        for at in range(0, len(every), TOGETHER):
            part = every[at : at + TOGETHER].T
            x = self.table[np.maximum(part, 0)]
            np.maximum.at(best, text[at : at + TOGETHER], self.network.forward(x, part >= 0))
        return sigmoid(best)
