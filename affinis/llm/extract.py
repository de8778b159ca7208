"""Main text of web pages: a bidirectional LSTM labels every block with the whole page in view."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.llm.html_blocks import Block, blocks
from affinis.llm.layouts import CONTENT, OTHER, Layout

#: Buckets of path names and of words, other inputs, cells of each direction.
PATH, WORDS, PLAIN, CELLS = 192, 32, 8, 24
WIDTH = PATH + WORDS + PLAIN
#: Made-up pages to learn from, rounds over them, pages of a step, step size.
PAGES, ROUNDS, STEP, RATE = 1200, 6, 24, 0.01
#: Blocks of a padded group of pages labelled at once, and pages parsed at once.
GROUP, AT_ONCE = 20_000, 128


@cache
def _bucket(name: str, size: int) -> int:
    return zlib.crc32(name.encode()) % size


def features(page: list[Block], paths: dict) -> np.ndarray:
    """One row per block: counts of hashed path names, share of hashed words, and shape."""
    out = np.zeros((len(page), WIDTH), np.float32)
    for i, b in enumerate(page):
        if (row := paths.get(b.path)) is None:
            row = np.zeros(PATH, np.float32)
            for name in b.path:
                row[_bucket(name, PATH)] = 1
            if len(paths) < 50_000:
                paths[b.path] = row
        out[i, :PATH] = row
        words = b.text.lower().split()
        marks = np.fromiter((zlib.crc32(w.encode("utf-8", "replace")) & (WORDS - 1) for w in words), np.int64, len(words))
        out[i, PATH : PATH + WORDS] = np.bincount(marks, minlength=WORDS) / len(words)
        n = len(b.text)
        out[i, PATH + WORDS :] = (
            np.log1p(n) / 8, np.log1p(len(words)) / 6, b.linked / n, b.text.endswith((".", "!", "?")), len(b.path) / 12,
            i / len(page), i == 0, 1,
        )
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class BlockLabeller:
    """Weights of two LSTMs, one from each end of the page, and of the label."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        small = lambda *shape: (r.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.p = {}
        for d in "fb":
            self.p |= {f"W{d}": small(WIDTH, 4 * CELLS), f"U{d}": small(CELLS, 4 * CELLS), f"b{d}": np.zeros(4 * CELLS, np.float32)}
            self.p[f"b{d}"][CELLS : 2 * CELLS] = 1  # remember at first
        self.p |= {"V": small(2 * CELLS, 1), "v": np.zeros(1, np.float32), "S": np.zeros((WIDTH, 1), np.float32)}

    def _run(self, x: np.ndarray, mask: np.ndarray, d: str) -> tuple[np.ndarray, list]:
        n, steps, _ = x.shape
        z_in = x @ self.p[f"W{d}"] + self.p[f"b{d}"]
        h = c = np.zeros((n, CELLS), np.float32)
        out, memory = np.zeros((n, steps, CELLS), np.float32), []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = z_in[:, t] + h @ self.p[f"U{d}"]
            gates = _sigmoid(z[:, : 3 * CELLS])
            i, f, o = gates[:, :CELLS], gates[:, CELLS : 2 * CELLS], gates[:, 2 * CELLS :]
            g = np.tanh(z[:, 3 * CELLS :])
            m = mask[:, t, None]
            c1 = f * c + i * g
            th = np.tanh(c1)
            memory.append((t, h, c, i, f, o, g, th, m))
            c = m * c1 + (1 - m) * c
            h = m * (o * th) + (1 - m) * h
            out[:, t] = h
        return out, memory

    def logits(self, x: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, tuple]:
        forward, mf = self._run(x, mask, "f")
        backward, mb = self._run(x, mask, "b")
        both = np.concatenate([forward, backward], 2)
        return (both @ self.p["V"] + x @ self.p["S"])[:, :, 0] + self.p["v"], (both, mf, mb)

    def gradient(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy of the blocks and its gradient."""
        z, (both, mf, mb) = self.logits(x, mask)
        p = _sigmoid(z)
        total = mask.sum()
        loss = -float((mask * (y * np.log(p + 1e-7) + (1 - y) * np.log(1 - p + 1e-7))).sum() / total)
        dz = (mask * (p - y) / total)[:, :, None]
        grad = {"V": np.einsum("ntc,nto->co", both, dz), "v": dz.sum((0, 1)), "S": np.einsum("ntc,nto->co", x, dz)}
        d_both = dz @ self.p["V"].T
        for d, memory, dh_out in (("f", mf, d_both[:, :, :CELLS]), ("b", mb, d_both[:, :, CELLS:])):
            dw, du, db = (np.zeros_like(self.p[f"{k}{d}"]) for k in "WUb")
            dh_next = dc_next = np.zeros((len(x), CELLS), np.float32)
            for t, h, c, i, f, o, g, th, m in reversed(memory):
                dh = dh_out[:, t] + dh_next
                dhm, dcm = dh * m, dc_next * m
                dc = dhm * o * (1 - th**2) + dcm
                dz_t = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dhm * th * o * (1 - o), dc * i * (1 - g**2)], 1)
                dw += x[:, t].T @ dz_t
                du += h.T @ dz_t
                db += dz_t.sum(0)
                dh_next = dz_t @ self.p[f"U{d}"].T + dh * (1 - m)
                dc_next = dc * f + dc_next * (1 - m)
            grad |= {f"W{d}": dw, f"U{d}": du, f"b{d}": db}
        return loss, grad

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Whether each block of each page is part of the article."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            to = at + 1
            while to < len(order) and len(pages[order[to]]) * (to - at + 1) <= GROUP:
                to += 1
            x, mask = padded([pages[i] for i in order[at:to]])
            z, _ = self.logits(x, mask)
            for k, i in enumerate(order[at:to]):
                out[i] = z[k, : len(pages[i])] > 0
            at = to
        return out


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, pages))
    x, mask = np.zeros((len(pages), steps, WIDTH), np.float32), np.zeros((len(pages), steps), np.float32)
    for k, p in enumerate(pages):
        x[k, : len(p)], mask[k, : len(p)] = p, 1
    return x, mask


def labelled(seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of a made-up page; the marks of its texts are taken off first."""
    page, y = [], []
    for b in blocks(Layout(seed).html()):
        own, others = b.text.count(CONTENT), b.text.count(OTHER)
        y.append(float(own >= others))
        page.append(Block(b.text.replace(CONTENT, "").replace(OTHER, "") or "x", b.path, b.linked))
    return features(page, {}), np.array(y, np.float32)


@cache
def trained(pages: int = PAGES, rounds: int = ROUNDS) -> BlockLabeller:
    """The labeller, trained on made-up layouts; the same on every run."""
    model = BlockLabeller()
    data = [labelled(s) for s in range(pages)]
    order = sorted(range(len(data)), key=lambda i: len(data[i][1]))
    steps = [order[i : i + STEP] for i in range(0, len(order), STEP)]
    first, second = ({k: np.zeros_like(v) for k, v in model.p.items()} for _ in range(2))
    r, n = np.random.default_rng(1), 0
    for k in range(rounds):
        for s in r.permutation(len(steps)):
            x, mask = padded([data[i][0] for i in steps[s]])
            y = np.zeros(mask.shape, np.float32)
            for j, i in enumerate(steps[s]):
                y[j, : len(data[i][1])] = data[i][1]
            _, grad = model.gradient(x, mask, y)
            n += 1
            for name, g in grad.items():
                first[name] = 0.9 * first[name] + 0.1 * g
                second[name] = 0.99 * second[name] + 0.01 * g * g
                step = first[name] / (1 - 0.9**n) / (np.sqrt(second[name] / (1 - 0.99**n)) + 1e-6)
                model.p[name] -= np.float32(RATE * (0.5 if k > rounds // 2 else 1)) * step
    return model


def main_texts(pages: list[str | None], model: BlockLabeller) -> list[str]:
    paths: dict = {}
    parsed = [blocks(p) for p in pages]
    kept = model.label([features(p, paths) for p in parsed])
    return [" ".join(b.text for b, k in zip(p, keep, strict=True) if k) for p, keep in zip(parsed, kept, strict=True)]


def extract(pages: DataFrame, keep: list[str], html_col: str = "html", model: BlockLabeller | None = None) -> DataFrame:
    """Columns ``keep`` of every row with ``text``, the article, and ``n_chars``, its code points.

    The whole page is read. Blocks are runs of visible text between block elements; character
    references are decoded, white space inside a block is one space, and the blocks of the
    article are joined by one space. A null or empty page, or one without an article, gives an
    empty text. Null ids and repeated rows are kept; other columns are ignored; ``keep`` must not
    hold the two new names.
    """
    model = model or trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x.slice(i, AT_ONCE) for x in batches for i in range(0, x.num_rows, AT_ONCE)):
            texts = main_texts(b.column(b.num_columns - 1).to_pylist(), model)
            columns = [*b.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "text", "n_chars"])

    rows = pages.select(*keep, F.col(html_col).cast("string").alias("_html"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{schema}, text string, n_chars bigint")
