"""Language-model scores: a causal self-attention model in numpy over subword ids.

Words (A-Z lower-cased, split at white space) are counted over all training documents in Spark.
The counts give the base score; and since each distinct word is turned into subword ids once,
they also give the corpus-wide frequency of every id, which is the model's prior: ids are dealt
to classes (the most frequent ones are classes of their own), the model predicts the class of
the next id from its context on top of the prior, and the prior shares a class out to its ids. In
a ClassTree, which the query uses, classes stand in groups: the model predicts the group, then the
class among those of the group.

The model has one masked attention head, whose output is added to the last id's own vector; there
is no hidden layer after it. It first learns from a bounded number of ids (`warm_ids`) on the
driver, blocks that a hash picks from texts of any length; then every partition goes on learning
from all its training documents, and the weight changes are averaged by ids in a Spark
aggregation, so training grows with the corpus and only the model's own size meets in the
driver. A text is scored in blocks of QUERY ids, each of which sees the QUERY ids before the
block too: windows overlap, every id is scored once, blocks of many texts are one batch.

For the base score the most frequent words, `head` at most, are broadcast; all other words of the
documents are counted per document and joined with the table of counts by word. Both ways are
exact.

Defined cases: null is empty; an empty text is one token, its end; a null id counts as the empty
text and is held out; repeated rows are rows of their own; without training documents all counts
are zero; other columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import itertools
import math
import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystone.llm.common import about, fold, lean, mix, read, stage, text_of

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
IDS, END = 50_257, 50_256
#: Words of letters, of digits, of other signs; a blank belongs to the word after it.
PIECES = r" ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"
#: White space beyond ASCII, in UTF-8.
_WIDE_BLANKS = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
HEAD = 131_072
WIDTH = 16
QUERY = 8
#: Ids that are classes of their own, and all classes: the context tells own ones apart, and the others by class only.
OWN_CLASSES, CLASSES = 480, 512
WARM_IDS = 300_000
#: Blocks of a step in the warm-up and later, and the rates to match.
RATE, BATCH = 0.02, 32
LATER_RATE, LATER_BATCH = 0.01, 512
#: Distinct words whose ids a task remembers.
KNOWN_WORDS = 200_000
_AT_ONCE = 1024
#: Classes of a ClassTree, those of one id among them, and their groups.
OWN_LEAVES, LEAVES, GROUPS = 960, 1024, 16
#: Ids whose CLASSES are weighed at once: that many masses stay in a core's cache.
_TILE = 128
_WORDS_AT_ONCE = 100_000
#: Text that is split at once.
_BYTES_AT_ONCE = 4 << 20


def load_vocabulary(path: str) -> dict[bytes, int]:
    """Subword -> id, from a vocabulary file; read on the driver, broadcast to the tasks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Subwords:
    """Ids of words; a blank before each word ends the one before, so a text's ids are its words' ids,
    each word encoded by itself.

    The ids of words met before are kept in one array, KNOWN_WORDS at most: a text is then a list of
    places in it. When that is full, it is begun anew."""

    def __init__(self, vocabulary: str | dict[bytes, int]):
        import tiktoken

        ranks = load_vocabulary(vocabulary) if isinstance(vocabulary, str) else vocabulary
        self.encoding = tiktoken.Encoding("words", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
        self.opens = np.zeros(IDS, bool)
        self.opens[[i for subword, i in ranks.items() if subword.startswith(b" ")]] = True
        self._forget()

    def _forget(self) -> None:
        self.place: dict[bytes, int] = {}
        self.starts, self.lengths = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.ids, self.used = np.zeros(4096, np.int32), 0

    def of_words(self, words: list[bytes]) -> np.ndarray:
        """The ids of the words, without keeping any."""
        text = b" " + b" ".join(words)
        return np.array(self.encoding.encode_ordinary(text.decode("utf-8", "replace")), np.int32)

    def _keep(self, words: list[bytes]) -> None:
        """Encode distinct new words at once. Each begins with a blank, and none holds another one, so
        the ids that begin with a blank tell the words apart; words with blanks beyond ASCII, which could
        swallow the next word's, are encoded one by one."""
        if any(map(_WIDE_BLANKS.search, words)):
            each = [self.of_words([w]) for w in words]
            ids, first = np.concatenate(each), np.cumsum([0, *map(len, each[:-1])])
        else:
            ids = self.of_words(words)
            first = np.flatnonzero(self.opens[ids])
        n, more = len(self.place), len(words)
        while n + more > len(self.starts):
            self.starts, self.lengths = np.resize(self.starts, 2 * len(self.starts)), np.resize(self.lengths, 2 * len(self.lengths))
        while self.used + len(ids) > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        self.starts[n : n + more] = self.used + first
        self.lengths[n : n + more] = np.diff(first, append=len(ids))
        self.ids[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.place.update(zip(words, range(n, n + more), strict=True))

    def spans(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of the words start in `ids`, and how many they are; until the next call."""
        if len(self.place) > KNOWN_WORDS or self.used > 8 * KNOWN_WORDS:
            self._forget()
        places = list(map(self.place.get, words))
        if None in places:
            self._keep(list(dict.fromkeys(w for w, p in zip(words, places, strict=True) if p is None)))
            places = list(map(self.place.get, words))
        places = np.array(places, np.int64)
        return self.starts[places], self.lengths[places]

    def between(self, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The ids of spans, one after the other."""
        first = np.cumsum(lengths) - lengths
        return self.ids.take(np.arange(lengths.sum()) + np.repeat(starts - first, lengths))

    def of_text(self, words: list[bytes]) -> np.ndarray:
        """END, the ids of the words, END."""
        end = np.array([END], np.int32)
        parts = [end]
        for at in range(0, len(words), _WORDS_AT_ONCE):
            parts.append(self.between(*self.spans(words[at : at + _WORDS_AT_ONCE])))
        return np.concatenate([*parts, end])

    def of_texts(self, owner: np.ndarray, codes: np.ndarray, words: list[bytes], texts: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts as of_text gives them, one after the other, and where each begins and the
        last one ends. A text's words are the codes, in `words`, that it owns."""
        sizes, out = np.full(texts, 2), []
        for at in range(0, max(len(words), 1), _WORDS_AT_ONCE):
            starts, lengths = self.spans(words[at : at + _WORDS_AT_ONCE])
            mine = np.flatnonzero((codes >= at) & (codes < at + _WORDS_AT_ONCE)) if len(words) > _WORDS_AT_ONCE else np.arange(len(codes))
            local = codes[mine] - at
            out.append((mine, starts[local], lengths[local], self.ids))
        lengths = np.zeros(len(codes), np.int64)
        for mine, _, some, _ in out:
            lengths[mine] = some
        sizes += np.bincount(owner, lengths, texts).astype(np.int64)
        edges = np.concatenate([[0], np.cumsum(sizes)])
        ids = np.full(edges[-1], END, np.int32)
        first = np.cumsum(lengths) - lengths + 2 * owner + 1
        for mine, starts, some, known in out:
            begin = np.cumsum(some) - some
            step = np.arange(some.sum())
            ids[step + np.repeat(first[mine] - begin, some)] = known.take(step + np.repeat(starts - begin, some))
        return ids, edges


_built: list[tuple[dict, Subwords]] = []


def subwords_of(shared) -> Subwords:
    """The encoder of a broadcast vocabulary, built once in each worker."""
    ranks = shared.value
    if not _built or _built[0][0] is not ranks:
        _built[:] = [(ranks, Subwords(ranks))]
    return _built[0][1]


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def blocks_of(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(inputs, targets): rows of 2 * QUERY ids and of the QUERY ids that follow the later half; -1 where there is none."""
    n = len(ids) - 1
    count = -(-n // QUERY)
    given = np.full((count + 1) * QUERY, -1, np.int32)
    given[QUERY : QUERY + n] = ids[:-1]
    targets = np.full(count * QUERY, -1, np.int32)
    targets[:n] = ids[1:]
    return np.lib.stride_tricks.sliding_window_view(given, 2 * QUERY)[::QUERY], targets.reshape(count, QUERY)


def first_blocks(at: np.ndarray, rows: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows with the smallest numbers, `most` of them, in that order; equal ones by content."""
    order = np.lexsort((*rows.T[::-1], at))[:most] if len(at) else np.empty(0, int)
    return at[order], rows[order]


class Prior:
    """Classes of ids and their shares, from the counts of ids in the corpus."""

    def __init__(self, counts: np.ndarray, own: int = OWN_CLASSES, classes: int = CLASSES):
        share = (counts + 0.1) / (counts + 0.1).sum()
        order = np.argsort(-share, kind="stable")
        self.of = np.empty(IDS, np.int32)
        self.of[order[:own]] = np.arange(own)
        rest = order[own:]
        mass = np.cumsum(share[rest])
        self.of[rest] = own + np.minimum(mass / mass[-1] * (classes - own), classes - own - 1).astype(int)
        total = np.maximum(np.bincount(self.of, share, classes), 1e-30)
        self.classes = np.log(total).astype(np.float32)
        self.within = (np.log(share) - np.log(total)[self.of]).astype(np.float32)


class GroupedPrior(Prior):
    """Twice the classes, in groups of neighbours by frequency: the more frequent, the smaller a group,
    so that an id meets few others in its own."""

    def __init__(self, counts: np.ndarray):
        super().__init__(counts, OWN_LEAVES, LEAVES)
        # Sizes as the inverse root of the share: the least sum of share times size.
        share = np.exp(self.classes.astype(float))
        steps = np.cumsum(np.sqrt(share))
        self.group = np.minimum(steps / steps[-1] * GROUPS, GROUPS - 1).astype(np.uint8)
        self.first = np.searchsorted(self.group, np.arange(GROUPS + 1))
        self.groups = np.log(np.maximum(np.bincount(self.group, share, GROUPS), 1e-30)).astype(np.float32)


def _times(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """x @ w as one product of two matrices, however many blocks there are."""
    return (x.reshape(-1, x.shape[-1]) @ w).reshape(*x.shape[:-1], w.shape[1])


def _masses(h: np.ndarray, w: np.ndarray, bias: np.ndarray, own: np.ndarray):
    """(rows, unnormalised probabilities of the columns of w, their sums, places of the own ones in them),
    tile by tile: bounded, so that no exponential overflows."""
    largest = np.sqrt(np.einsum("ij,ij->i", h, h).max(initial=0) * np.einsum("ij,ij->j", w, w).max())
    width = w.shape[1]
    ones, step = np.ones(width, h.dtype), max(1, _TILE * CLASSES // width)
    for at in range(0, len(h), step):
        rows = slice(at, at + step)
        logits = h[rows] @ w
        if not largest < 60:
            np.clip(logits, -60, 60, out=logits)
        logits += bias
        np.exp(logits, out=logits)
        yield rows, logits, logits @ ones, np.arange(len(logits)) * width + own[rows]


def _log_shares(h: np.ndarray, w: np.ndarray, bias: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Natural log-probability of each row's own column."""
    out = np.empty(len(h), h.dtype)
    for rows, p, total, at in _masses(h, w, bias, own):
        np.log(np.maximum(p.ravel().take(at), 1e-37) / total, out=out[rows])
    return out


def _share_gradients(h: np.ndarray, w: np.ndarray, bias: np.ndarray, own: np.ndarray, weight: np.ndarray):
    """(loss, gradients of h, w and bias) of the weighted log-probabilities of the rows' own columns."""
    dh, dw, dbias, loss = np.empty_like(h), np.zeros_like(w), np.zeros_like(bias, h.dtype), 0.0
    for rows, d, total, at in _masses(h, w, bias, own):
        flat = d.ravel()
        mine = flat.take(at)
        loss -= float(weight[rows] @ np.log(np.maximum(mine / total, 1e-30)))
        flat[at] = mine - total
        scale = (weight[rows] / total)[:, None]
        dw += (h[rows] * scale).T @ d
        dbias += scale[:, 0] @ d
        np.multiply(d @ w.T, scale, out=dh[rows])
    return loss, dh, dw, dbias


@functools.cache
def _ones(n: int, kind) -> np.ndarray:
    return np.ones(n, kind)


class Attention:
    """One causal attention head, over the classes of a Prior."""

    PRIOR = Prior

    def __init__(self, prior: Prior, seed: int = 8):
        rng = np.random.default_rng(seed)

        def drawn(*shape: int) -> np.ndarray:
            return rng.normal(0, 1 / math.sqrt(shape[0]), shape).astype(np.float32)

        d, classes = WIDTH, len(prior.classes)
        self.prior = prior
        self.weights = {
            "ids": rng.normal(0, 0.3, (IDS, d)).astype(np.float32), "places": rng.normal(0, 0.1, (2 * QUERY, d)).astype(np.float32),
            "q": drawn(d, d), "k": drawn(d, d), "v": drawn(d, d), "o": drawn(d, d), "classes": 0.1 * drawn(d, classes), "shift": np.zeros(classes, np.float32),
        }
        later = np.arange(2 * QUERY)[None, :] > np.arange(QUERY, 2 * QUERY)[:, None]
        self.later = np.where(later, np.float32(-1e9), np.float32(0))

    def attended(self, inputs: np.ndarray) -> dict[str, np.ndarray]:
        """What each of the later QUERY ids of a block becomes after attention, and the steps to it. Keys
        and values need not be made: with one head, q k' and v o are products of weights alone."""
        w = self.weights
        gaps = inputs < 0
        x = w["ids"].take(np.maximum(inputs, 0), axis=0)
        x += w["places"]
        mine = np.ascontiguousarray(x[:, QUERY:])
        qk, vo = w["q"] @ w["k"].T * np.float32(1 / math.sqrt(WIDTH)), w["v"] @ w["o"]
        q = _times(mine, qk)
        s = q @ x.transpose(0, 2, 1)
        s += self.later
        if gaps.any():
            s += np.where(gaps, np.float32(-1e9), np.float32(0))[:, None, :]
        np.minimum(s, np.float32(60), out=s)  # so that no exponential overflows
        np.exp(s, out=s)
        s /= np.maximum(np.einsum("bij->bi", s), np.float32(1e-30))[:, :, None]
        o = s @ x
        return {"x": x, "mine": mine, "qk": qk, "vo": vo, "q": q, "a": s, "o": o, "h": mine + _times(o, vo)}

    def forward(self, inputs: np.ndarray) -> dict[str, np.ndarray]:
        f = self.attended(inputs)
        logits = f["h"].reshape(-1, WIDTH) @ self.weights["classes"] + (self.weights["shift"] + self.prior.classes)
        return f | {"logits": logits - logits.max(axis=1, keepdims=True)}

    def _log_classes(self, h: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Natural log-probability of each row's class."""
        return _log_shares(h, self.weights["classes"], self.weights["shift"] + self.prior.classes, classes)

    def _class_gradients(self, h: np.ndarray, classes: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray, dict[str, np.ndarray]]:
        """(loss, gradients of h, and of the weights after it)."""
        w = self.weights
        loss, dh, dw, dshift = _share_gradients(h, w["classes"], w["shift"] + self.prior.classes, classes, weight)
        return loss, dh, {"classes": dw, "shift": dshift}

    def log_likelihood(self, inputs: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Natural log-probability of each block's targets."""
        flat = targets.ravel()
        safe = np.maximum(flat, 0)
        out = self._log_classes(self.attended(inputs)["h"].reshape(-1, WIDTH), self.prior.of.take(safe))
        out += self.prior.within.take(safe)
        return np.where(flat < 0, 0, out.astype(np.float64)).reshape(targets.shape).sum(axis=1)

    def gradients(self, inputs: np.ndarray, targets: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        w, f = self.weights, self.attended(inputs)
        flat = targets.ravel()
        real = flat >= 0
        h = f["h"].reshape(-1, WIDTH)
        loss, dh, out = self._class_gradients(h, self.prior.of.take(np.maximum(flat, 0)), (real / max(int(real.sum()), 1)).astype(h.dtype))
        dh = dh.reshape(len(inputs), QUERY, WIDTH)
        x, a, root = f["x"], f["a"], np.float32(1 / math.sqrt(WIDTH))
        dvo = f["o"].reshape(-1, WIDTH).T @ dh.reshape(-1, WIDTH)
        out["v"], out["o"] = dvo @ w["o"].T, w["v"].T @ dvo
        do = _times(dh, f["vo"].T)
        ds = do @ x.transpose(0, 2, 1)
        ds -= np.einsum("bij,bij->bi", ds, a)[:, :, None]
        ds *= a
        dq = ds @ x
        dqk = f["mine"].reshape(-1, WIDTH).T @ dq.reshape(-1, WIDTH)
        out["q"], out["k"] = dqk @ w["k"] * root, dqk.T @ w["q"] * root
        # Both ways to an id, as what it gives and as what it is asked by, in one product.
        dx = np.concatenate([a, ds], axis=1).transpose(0, 2, 1) @ np.concatenate([do, f["q"]], axis=1)
        dmine = _times(dq, f["qk"].T)
        dmine += dh
        dx[:, QUERY:] += dmine
        gaps = inputs < 0
        if gaps.any():
            dx[gaps] = 0
        out["places"] = dx.sum(axis=0)
        flat = np.maximum(inputs, 0).ravel().astype(np.uint16)
        order = np.argsort(flat, kind="stable")
        flat = flat.take(order)
        first = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
        out["ids"] = (flat[first], np.add.reduceat(dx.reshape(-1, WIDTH).take(order, axis=0), first, axis=0))
        return loss, out

    def learn(self, batches, rate: float) -> int:
        """Adagrad over (inputs, targets) batches; the ids learnt from."""
        squares = {name: np.full(w.shape, 1e-8, np.float32) for name, w in self.weights.items()}
        learnt = 0
        for inputs, targets in batches:
            learnt += int((targets >= 0).sum())
            for name, grad in self.gradients(inputs, targets)[1].items():
                rows = slice(None)
                if name == "ids":
                    rows, grad = grad
                square = squares[name][rows] + grad * grad
                squares[name][rows] = square
                grad *= np.float32(rate)
                grad /= np.sqrt(square)
                self.weights[name][rows] -= grad
        return learnt


class ClassTree(Attention):
    """Attention whose classes are told in two steps, a GroupedPrior's group and a class of that group. The
    probabilities are exact and sum to one over all ids; a few dozen masses are weighed for an id
    instead of all."""

    PRIOR = GroupedPrior

    def __init__(self, prior: GroupedPrior, seed: int = 8):
        super().__init__(prior, seed)
        rng = np.random.default_rng(seed + 1)
        self.weights |= {"groups": rng.normal(0, 0.1 / math.sqrt(WIDTH), (WIDTH, GROUPS)).astype(np.float32), "lean": np.zeros(GROUPS, np.float32)}

    def _weighed(self, h: np.ndarray, classes: np.ndarray):
        """An order that brings the rows of a group together; the rows in it; and parts: step 0 weighs the
        groups for all rows, step 1 the classes of a group for its rows. (step, rows, columns, weights,
        unnormalised probabilities) for each, and by step and row their sums, the own ones and where
        these stand. Shifts are a last row of the weights."""
        w, prior = self.weights, self.prior
        groups = prior.group.take(classes)
        order = np.argsort(groups, kind="stable")
        classes, groups = classes.take(order), groups.take(order)
        top = np.vstack([w["groups"], w["lean"] + prior.groups])
        low = np.vstack([w["classes"], w["shift"] + prior.classes])
        ends = np.searchsorted(groups, np.arange(GROUPS + 1)).tolist()
        n, first, number = len(h), prior.first, np.arange(len(h))
        parts = [(0, slice(0, n), slice(0, GROUPS), top)]
        parts += [(1, slice(a, b), slice(first[g], first[g + 1]), low[:, first[g] : first[g + 1]]) for g, (a, b) in enumerate(itertools.pairwise(ends)) if b > a]
        at = np.stack([number * GROUPS + groups, (number - np.take(ends, groups)) * np.diff(first).take(groups) + classes - first.take(groups)])
        given = np.empty((n, WIDTH + 1), h.dtype)
        h.take(order, axis=0, out=given[:, :WIDTH])
        given[:, WIDTH] = 1
        reach = np.sqrt(np.einsum("ij,ij->i", h, h).max(initial=0))
        bounded = all(reach * np.sqrt(np.einsum("ij,ij->j", w[x], w[x]).max()) < 60 for x in ("groups", "classes"))
        weighed, totals, own = [], np.empty((2, n), h.dtype), np.empty((2, n), h.dtype)
        for step, rows, columns, weights in parts:
            p = given[rows] @ weights
            if not bounded:  # so that no exponential overflows
                np.clip(p, -80, 80, out=p)
            np.exp(p, out=p)
            np.matmul(p, _ones(weights.shape[1], h.dtype), out=totals[step, rows])
            own[step, rows] = p.ravel().take(at[step, rows])
            weighed.append((step, rows, columns, weights, p))
        return order, given, weighed, totals, own, at

    def forward(self, inputs: np.ndarray) -> dict[str, np.ndarray]:
        f, prior = super().forward(inputs), self.prior
        top = f["h"].reshape(-1, WIDTH) @ self.weights["groups"] + (self.weights["lean"] + prior.groups)
        top -= np.log(np.exp(top - top.max(axis=1, keepdims=True)).sum(axis=1, keepdims=True)) + top.max(axis=1, keepdims=True)
        logits = f["logits"].copy()
        for g in range(GROUPS):
            some = slice(prior.first[g], prior.first[g + 1])
            if some.stop > some.start:
                most = logits[:, some].max(axis=1, keepdims=True)
                logits[:, some] += top[:, g : g + 1] - most - np.log(np.exp(logits[:, some] - most).sum(axis=1, keepdims=True))
        return f | {"logits": logits}

    def _log_classes(self, h: np.ndarray, classes: np.ndarray) -> np.ndarray:
        order, _, _, totals, own, _ = self._weighed(h, classes)
        shares = np.maximum(own, 1e-37) / totals
        out = np.empty(len(h), h.dtype)
        out[order] = np.log(shares, out=shares).sum(axis=0)
        return out

    def _class_gradients(self, h: np.ndarray, classes: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray, dict[str, np.ndarray]]:
        order, given, weighed, totals, own, at = self._weighed(h, classes)
        weight = weight.take(order)
        loss = -float((np.log(np.maximum(own / totals, 1e-30)) @ weight).sum())
        scale, less = weight / totals, own - totals
        scaled = given * scale[:, :, None]
        grads = np.zeros((WIDTH + 1, GROUPS), h.dtype), np.zeros((WIDTH + 1, LEAVES), h.dtype)
        dh = np.empty((2, len(h), WIDTH), h.dtype)
        for step, rows, columns, weights, d in weighed:
            d.ravel()[at[step, rows]] = less[step, rows]
            np.matmul(d, weights[:WIDTH].T, out=dh[step, rows])
            grads[step][:, columns] = scaled[step, rows].T @ d
        dh *= scale[:, :, None]
        out = np.empty_like(h)
        out[order] = dh[0] + dh[1]
        return loss, out, {"groups": grads[0][:WIDTH], "lean": grads[0][WIDTH], "classes": grads[1][:WIDTH], "shift": grads[1][WIDTH]}


def _in_batches(pairs, size: int):
    """Batches of `size` blocks from (inputs, targets) of texts."""
    held, count = [], 0
    for inputs, targets in pairs:
        for at in range(0, len(inputs), size):
            held.append((inputs[at : at + size], targets[at : at + size]))
            count += len(held[-1][0])
            if count >= size:
                yield np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
                held, count = [], 0
    if held:
        yield np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])


def _some(column, step: int = 64):
    for at in range(0, len(column), step):
        yield from text_of(column.slice(at, step))


def _slices(column):
    """(first, end) of slices of a text column of _BYTES_AT_ONCE about, of one text at least."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    after = np.cumsum(sizes, dtype=np.int64)
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(after, after[at] - sizes[at] + _BYTES_AT_ONCE, side="right")))
        yield at, end
        at = end


def _worded(column):
    """(texts, owner, codes, words): for each word of a slice of a text column, its text's number and its place
    among the distinct words, as words_of has them."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if pa.types.is_binary(column.type):
        column = column.view(pa.string())
    for at, end in _slices(column):
        split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(column.slice(at, end - at), "")))
        owner = np.repeat(np.arange(end - at), pc.list_value_length(split).to_numpy(zero_copy_only=False))
        flat = split.flatten()
        real = pc.greater(pc.binary_length(flat), 0)  # blanks at an end leave an empty word
        if not pc.all(real).as_py():
            owner, flat = owner[real.to_numpy(zero_copy_only=False)], flat.filter(real)
        flat = flat.dictionary_encode()
        yield end - at, owner, flat.indices.to_numpy(zero_copy_only=False), flat.dictionary.view(pa.binary())


def _count_words(batches):
    import pyarrow as pa

    for batch in batches:
        for _, _, codes, words in _worded(batch.column(0)):
            yield pa.RecordBatch.from_arrays([words, pa.array(np.bincount(codes, minlength=len(words)), pa.int64())], names=["word", "n"])


def _count_ids(shared):
    def run(batches):
        import pyarrow as pa

        subwords, total = subwords_of(shared), np.zeros(IDS, np.int64)
        for batch in batches:
            # Words that occur equally often are encoded together.
            by_count: dict[int, list[bytes]] = {}
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                by_count.setdefault(n, []).append(word)
            for n, words in by_count.items():
                for at in range(0, len(words), _WORDS_AT_ONCE):
                    ids, times = np.unique(subwords.of_words(words[at : at + _WORDS_AT_ONCE]), return_counts=True)
                    total[ids] += n * times
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], names=["id", "n"])

    return run


def _rows_of(model: Attention, before: dict[str, np.ndarray], learnt: int):
    """(part, row, values): changes of the weights in rows of WIDTH, times the ids learnt from."""
    for part, name in enumerate(sorted(before)):
        change = (model.weights[name] - before[name]).reshape(-1, WIDTH) * np.float32(learnt)
        rows = np.flatnonzero(change.any(axis=1))
        yield part, rows, change[rows]


def train(docs: DataFrame, words: DataFrame, n_docs: int, vocabulary, warm_ids: int = WARM_IDS, encoded: DataFrame | None = None, network: type[Attention] = Attention) -> Attention:
    """The model, from training documents (key, text), the table of their words' counts, and a
    vocabulary: the path of its file, or its content as a broadcast. `encoded` has the ids of the
    documents, if they are there already; `network` is Attention or ClassTree."""
    spark = docs.sparkSession
    if isinstance(vocabulary, str):
        vocabulary = spark.sparkContext.broadcast(load_vocabulary(vocabulary))
    counted = words.mapInArrow(lean(_count_ids(vocabulary)), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(IDS)
    counts[counted["id"].to_numpy(int)] = counted["n"].to_numpy(float)
    counts[END] = n_docs
    model = network(network.PRIOR(counts))

    # Warm-up: of the blocks of some documents of any length, those that come first by a hash.
    wanted = -(-warm_ids // QUERY)

    def blocks(batches):
        import pyarrow as pa

        subwords = subwords_of(vocabulary)
        for batch in batches:
            at, kept = np.empty(0, np.uint64), np.empty((0, 3 * QUERY), np.int32)
            for seed, text in zip(batch.column(0).to_pylist(), _some(batch.column(1)), strict=True):
                new = np.hstack(blocks_of(subwords.of_text(words_of(text))))
                with np.errstate(over="ignore"):
                    number = mix(np.uint64(seed % (1 << 64)) + np.arange(len(new), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                at, kept = first_blocks(np.concatenate([at, number]), np.concatenate([kept, new]), wanted)
            yield pa.RecordBatch.from_arrays([pa.array(at.view(np.int64)), pa.array([k.tobytes() for k in kept], pa.binary())], names=["at", "ids"])

    hashed = F.xxhash64("key", F.lit(8))
    n_some = max(8, math.ceil(2 * warm_ids / max(counts.sum(), 1) * n_docs))
    chosen = docs.where(about(hashed, n_some, n_docs)).select(hashed.alias("at"), "text")
    found = chosen.mapInArrow(lean(blocks), "at long, ids binary").toPandas()
    if len(found):
        rows = np.frombuffer(b"".join(found["ids"]), np.int32).reshape(-1, 3 * QUERY)
        _, rows = first_blocks(found["at"].to_numpy(np.int64).view(np.uint64), rows, wanted)
        order = np.random.default_rng(8).permutation(len(rows))
        inputs, targets = rows[order, : 2 * QUERY], rows[order, 2 * QUERY :]
        model.learn(((inputs[a : a + BATCH], targets[a : a + BATCH]) for a in range(0, len(order), BATCH)), RATE)

    # One round over all training documents, partition by partition.
    start = spark.sparkContext.broadcast(model)
    columns = [f"v{i}" for i in range(WIDTH)]

    from_texts = encoded is None

    def go_on(batches):
        import pyarrow as pa

        mine = network(start.value.prior)
        before = start.value.weights
        mine.weights = {k: v.copy() for k, v in before.items()}
        if from_texts:
            subwords = subwords_of(vocabulary)
            texts = (subwords.of_text(words_of(t)) for batch in batches for t in _some(batch.column(0)))
        else:
            texts = (np.frombuffer(t, np.uint16).astype(np.int32) for batch in batches for t in batch.column(0).to_pylist())
        learnt = mine.learn(_in_batches(map(blocks_of, texts), LATER_BATCH), LATER_RATE)
        if learnt:
            for part, rows, values in _rows_of(mine, before, learnt):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), part), pa.int64()), pa.array(rows, pa.int64()), *(pa.array(values[:, i].astype(float)) for i in range(WIDTH))],
                    names=["part", "row", *columns],
                )
            yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int64()), pa.array([0], pa.int64()), *(pa.array([float(learnt)]) for _ in columns)], names=["part", "row", *columns])

    given = docs.select("text") if from_texts else encoded.select("ids")
    changes = given.mapInArrow(lean(go_on), "part long, row long, " + ", ".join(f"{c} double" for c in columns))
    sums = changes.groupBy("part", "row").agg(*[F.sum(c).alias(c) for c in columns]).toPandas()
    start.destroy()
    learnt = sums.loc[sums["part"] == -1, "v0"].sum()
    if learnt:
        for part, name in enumerate(sorted(model.weights)):
            mine = sums[sums["part"] == part]
            flat = model.weights[name].reshape(-1, WIDTH)
            flat[mine["row"].to_numpy(int)] += (mine[columns].to_numpy() / learnt).astype(np.float32)
    return model


def score(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", divisor: int = 10, held: int = 0, vocabulary: str = VOCABULARY, head: int = HEAD, **options) -> DataFrame:
    """Per document: held_out, n_tokens, n_known, train_tokens, base_score and the model's score."""
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_column}`").alias("key"), F.col(f"`{text_column}`").alias("text"), (fold(f"`{id_column}`", divisor) == held).alias("held_out"))
    training = rows.where("not held_out").select("key", "text")
    words = stage(training.select("text").mapInArrow(lean(_count_words), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    distinct, tokens = words.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    n_docs = training.count()
    tokens, distinct = tokens + n_docs, distinct + (n_docs > 0)
    base = math.log10(tokens + 0.1 * (distinct + 1))
    # The head: the most frequent words, down to the step of a logarithmic scale that fits.
    steps = F.floor(F.log2("n") * 8)
    least, so_far = 1 << 30, 0
    for row in words.groupBy(steps.alias("step")).agg(F.count("*").alias("n")).orderBy(F.col("step").desc()).collect():
        so_far += row["n"]
        if so_far > head:
            break
        least = row["step"]
    top = words.where(steps >= least).toPandas()
    common = {bytes(w): math.log10(n + 0.1) - base for w, n in zip(top["word"], top["n"], strict=True)}
    ranks = spark.sparkContext.broadcast(load_vocabulary(vocabulary))
    shared = spark.sparkContext.broadcast(common)
    end = math.log10(n_docs + 0.1) - base

    def judge(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        known, subwords = shared.value, subwords_of(ranks)
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            done = 0
            for texts, owner, codes, words in _worded(batch.column(1)):
                distinct = words.to_numpy(zero_copy_only=False).tolist()
                ids, edges = subwords.of_texts(owner, codes, distinct, texts)
                value = np.array(list(map(known.get, distinct)), float)  # None is not a number
                mine = value[codes]
                rare = np.flatnonzero(np.isnan(mine))
                mine[rare] = 0
                n_words = np.bincount(owner, minlength=texts)
                n_known = n_words - np.bincount(owner[rare], minlength=texts) + (n_docs > 0)
                places, times = np.unique(owner[rare] * max(len(words), 1) + codes[rare], return_counts=True)
                tails = np.searchsorted(places, np.arange(texts + 1) * max(len(words), 1)).astype(np.int32)
                edges = (2 * edges).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(done, texts), batch.column(2).slice(done, texts), pa.array(np.arange(number, number + texts)),
                        pa.array(n_words + 1), pa.array(n_known), pa.array(end + np.bincount(owner, mine, texts)),
                        pa.ListArray.from_arrays(pa.array(tails), words.take(pa.array(places % max(len(words), 1)))), pa.ListArray.from_arrays(pa.array(tails), pa.array(times, pa.int64())),
                        pa.BinaryArray.from_buffers(pa.binary(), texts, [None, pa.py_buffer(edges), pa.py_buffer(ids.astype(np.uint16))]),
                    ],
                    names=["key", "held_out", "rid", "n_tokens", "n_known", "base", "words", "times", "ids"],
                )
                number, done = number + texts, done + texts

    # Texts are taken apart once: their ids are stored, for learning and for scoring.
    kind = rows.schema["key"].dataType.simpleString()
    facts = stage(
        rows.mapInArrow(lean(judge), f"key {kind}, held_out boolean, rid long, n_tokens long, n_known long, base double, words array<binary>, times array<long>, ids binary"),
        "lm-facts",
    )
    shared.destroy()
    model = train(training, words, n_docs, ranks, encoded=facts.where("not held_out"), **options)
    ranks.destroy()
    net = spark.sparkContext.broadcast(model)

    def evaluate(batches):
        import pyarrow as pa

        for batch in batches:
            scores = np.zeros(batch.num_rows)
            held_blocks, owner, count = [], [], 0
            for i, text in enumerate(batch.column(1).to_pylist()):
                inputs, targets = blocks_of(np.frombuffer(text, np.uint16).astype(np.int32))
                for a in range(0, len(inputs), _AT_ONCE):
                    held_blocks.append((inputs[a : a + _AT_ONCE], targets[a : a + _AT_ONCE]))
                    owner.append(np.full(len(held_blocks[-1][0]), i))
                    count += len(owner[-1])
                    if count >= _AT_ONCE:
                        _add(net.value, held_blocks, owner, scores)
                        held_blocks, owner, count = [], [], 0
            if owner:
                _add(net.value, held_blocks, owner, scores)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores / math.log(10))], names=["rid", "score"])

    scored = stage(facts.select("rid", "ids").mapInArrow(lean(evaluate), "rid long, score double"), "lm-scores")
    net.destroy()
    # The words beyond the head: one row per document and word, joined with their counts.
    tail = facts.select("rid", F.explode(F.arrays_zip("words", "times")).alias("w")).select("rid", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
    tail = tail.join(words.where(steps < least), "word", "left")
    value = F.log10(F.coalesce("n", F.lit(0)) + F.lit(0.1)) - F.lit(base)
    tail = tail.groupBy("rid").agg(F.sum(F.col("times") * value).alias("tail_base"), F.sum(F.when(F.col("n") > 0, F.col("times"))).alias("tail_known"))
    zero = F.lit(0)
    return facts.drop("words", "times", "ids").join(scored, "rid").join(tail, "rid", "left").select(
        F.col("key").alias(id_column),
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("tail_known", zero)).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("tail_base", zero)).alias("base_score"),
        "score",
    )


def _add(net: Attention, blocks, owner, scores: np.ndarray) -> None:
    found = net.log_likelihood(np.concatenate([b[0] for b in blocks]), np.concatenate([b[1] for b in blocks]))
    np.add.at(scores, np.concatenate(owner), found)


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(read(spark, sf_dir, "documents", "doc_id", "text"), network=ClassTree)
