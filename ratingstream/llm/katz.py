"""Katz backoff bigram scoring with Good-Turing discounts.

``P(w | v) = disc(c(v, w)) / c(v)`` if the pair was seen in training, else ``alpha(v) * P(w)``; and
``P(w) = disc(c(w)) / N``, with what the discounts leave going to one type for all unknown words.
``alpha(v)`` is the mass that v's discounts leave over the unigram mass of the words never
seen after v, so every context sums to one exactly. A context never seen leaves all to ``P(w)``.
Each text begins after, and ends with, the end token.

Discounts: Katz's for counts to ``k`` (from the counts of counts, of words and of pairs); above
``k`` a count loses ``tail``, so that every context keeps some mass to back off with. Where
the counts of counts give no discount between 0 and 1 (small or odd corpora), a count r
is discounted by half a count.

On Spark. Texts are cut into blocks of about ``block_bytes`` and written once as token numbers with
the block's own vocabulary (64-bit hashes stand for words). (1) The vocabularies are dealt
out by ranges of hashes; counts are summed, words numbered, and both go back to the blocks that asked.
(2) Each block deals its pairs out by context; a context that holds a large share of all
tokens is dealt out by pair. A part counts its pairs and returns, per document of each block, how
many of its pairs have each count, and which contexts it backed off from, told by how many
followers they have of each count: the discounts aren't known yet, and so needn't be.
(3) Hot contexts, whose followers lie in several parts, get their weights by a join.
No count is collected and no text read twice. All groups are bounded: a block's vocabulary, or
a part, whose number grows with the corpus. Pairs are sorted, numbered and compressed before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard as zstd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batches, crc_mod, kept, texts_of, words_of, written


@dataclass(frozen=True)
class KatzParams:
    k: int = 5
    tail: float = 0.1
    block_bytes: int = 16 << 20
    #: Words of block vocabularies per part in step 1, and pairs per part in step 2.
    part_words: int = 1_000_000
    part_pairs: int = 1_500_000


#: The end token's hash: no word is empty.
END = xxhash.xxh64_intdigest(b"", 0)


def freeze(**arrays: np.ndarray) -> bytes:
    """Arrays as one compressed byte string, their bytes grouped by significance."""
    c = zstd.ZstdCompressor(level=1)
    head, body = [], []
    for name, a in arrays.items():
        a = np.ascontiguousarray(a)
        z = c.compress(a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes())
        head.append(f"{name}:{a.dtype.str}:{len(a)}:{len(z)}")
        body.append(z)
    top = ",".join(head).encode()
    return len(top).to_bytes(4, "little") + top + b"".join(body)


def thaw(data: bytes) -> dict[str, np.ndarray]:
    n = int.from_bytes(data[:4], "little")
    at, out, d = 4 + n, {}, zstd.ZstdDecompressor()
    for part in data[4 : 4 + n].decode().split(","):
        name, kind, size, z = part.split(":")
        raw = d.decompress(data[at : at + int(z)], max_output_size=max(1, int(size) * np.dtype(kind).itemsize))
        at += int(z)
        planes = np.frombuffer(raw, np.uint8).reshape(np.dtype(kind).itemsize, int(size))
        out[name] = np.ascontiguousarray(planes.T).reshape(-1).view(kind)
    return out


def _small(a: np.ndarray) -> np.ndarray:
    """The narrowest unsigned type that holds the values."""
    top = int(a.max()) if len(a) else 0
    return a.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        return x ^ (x >> np.uint64(29))


class _Hashes(dict):
    """Word to hash, remembered per worker."""

    def __missing__(self, w: bytes) -> int:
        if len(self) > 600_000:
            self.clear()
        h = self[w] = xxhash.xxh64_intdigest(w, 0)
        return h


def _blocks(docs: DataFrame, p: KatzParams) -> DataFrame:
    """``docs(id, text, train)`` as blocks: ``block, n_words (of its vocabulary), n_tokens, words, data``."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, count = TaskContext.get().partitionId() << 32, 0
        hashes = kept("katz", 0, _Hashes)
        ids: list[int | None] = []
        train: list[bool] = []
        held: list[np.ndarray] = []
        size = 0

        def out() -> pa.RecordBatch:
            nonlocal count, size
            tokens = np.concatenate(held)
            vocabulary, place = np.unique(tokens, return_inverse=True)  # numbered in the order of hashes
            sizes = np.fromiter(map(len, held), np.int64, len(held))
            flags = np.array(train, bool)
            seen = np.bincount(place, np.repeat(flags, sizes), len(vocabulary)).astype(np.int64)
            words = freeze(word=vocabulary, seen=_small(seen))
            data = freeze(
                tokens=_small(place), end=np.searchsorted(vocabulary, np.array([END], np.uint64)), sizes=_small(sizes), train=flags.astype(np.uint8),
                ids=np.array([0 if i is None else i for i in ids], np.int64), null=np.array([i is None for i in ids]).astype(np.uint8),
            )
            row = [[base + count], [len(vocabulary)], [len(tokens)]]
            count, size = count + 1, 0
            for x in (ids, train, held):
                x.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in row] + [pa.array([z], pa.binary()) for z in (words, data)], ["block", "n_words", "n_tokens", "words", "data"])

        for b in batches(it, "text", 2 << 20):
            for i, t, tr in zip(b.column(0).to_pylist(), texts_of(b, "text"), b.column(2).to_pylist()):
                ws = words_of(t)
                held.append(np.fromiter([*map(hashes.__getitem__, ws), END], np.uint64, len(ws) + 1))
                ids.append(i)
                train.append(bool(tr))
                size += len(t or "") + 16
                if size >= p.block_bytes:
                    yield out()
        if held:
            yield out()

    return docs.mapInArrow(run, "block long, n_words long, n_tokens long, words binary, data binary")


def _part(h: np.ndarray, parts: int) -> np.ndarray:
    return (_mix(h) % np.uint64(parts)).astype(np.int64)


def _split_vocabulary(blocks: DataFrame, parts: int) -> DataFrame:
    """A row per block and range of hashes; a block's rows in order hold its words in order."""
    bounds = np.array([(i << 64) // parts for i in range(1, parts)], np.uint64)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for block, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                d = thaw(data)
                cut = [0, *np.searchsorted(d["word"], bounds), len(d["word"])]
                rows = [(q, freeze(word=d["word"][i:j], seen=d["seen"][i:j])) for q, i, j in zip(range(parts), cut, cut[1:]) if j > i]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([q for q, _ in rows], pa.int32()), pa.array([block] * len(rows), pa.int64()), pa.array([z for _, z in rows], pa.binary())],
                    ["part", "block", "data"],
                )

    return blocks.select("block", "words").mapInArrow(run, "part int, block long, data binary")


def _steps(a: np.ndarray) -> np.ndarray:
    """Ascending numbers as their differences (undone by ``cumsum``)."""
    return _small(np.diff(a, prepend=0))


def _sum_vocabulary(k: int):
    def run(table: pa.Table) -> pa.Table:
        rows = [thaw(z) for z in table["data"].to_pylist()]
        sizes = [len(r["word"]) for r in rows]
        words, place = np.unique(np.concatenate([r["word"] for r in rows]), return_inverse=True)
        total = np.bincount(place, np.concatenate([r["seen"].astype(np.int64) for r in rows]), len(words)).astype(np.int64)
        cut = np.cumsum(sizes)[:-1]
        back = [freeze(total=_small(total[at]), rank=_steps(at)) for at in np.split(place, cut)]
        part = table["part"][0].as_py()
        stats = np.concatenate([[total.sum(), (total > 0).sum()], np.bincount(np.minimum(total, k + 2), minlength=k + 3)[1 : k + 2]])
        return pa.table(
            {
                "part": pa.array([part] * (len(rows) + 1), pa.int32()),
                "block": pa.array([*table["block"].to_pylist(), None], pa.int64()),
                "data": pa.array([*back, freeze(stats=stats.astype(np.int64), words=np.array([len(words)]))], pa.binary()),
            }
        )

    return run


def discounts(n: np.ndarray, k: int) -> np.ndarray:
    """Katz's discount factors of counts 1 to k; ``n[r - 1]``: how many were seen r times, r to k + 1."""
    half = 1 - 0.5 / np.arange(1, k + 1)
    n = np.asarray(n, float)
    if (n[: k + 1] <= 0).any():
        return half
    r = np.arange(1, k + 1)
    rest = (k + 1) * n[k] / n[0]
    if rest >= 1:
        return half
    d = ((r + 1) * n[1 : k + 1] / n[:k] / r - rest) / (1 - rest)
    return np.where((d > 0) & (d < 1), d, half)


def discounted(count: np.ndarray, d: np.ndarray, tail: float) -> np.ndarray:
    """Counts after discounting (0 stays 0)."""
    c = np.asarray(count, float)
    low = np.concatenate([[0.0], d * np.arange(1, len(d) + 1)])
    return np.where(c <= len(d), low[np.minimum(c, len(d)).astype(np.int64)], c - tail)


@dataclass(frozen=True)
class Unigrams:
    """N, V and the discounts; ``unknown``: what the discounts leave, the one unknown type's mass."""

    total: int
    types: int
    d: np.ndarray
    tail: float
    unknown: float

    def prob(self, count: np.ndarray) -> np.ndarray:
        if not self.total:
            return np.ones(len(count))
        return np.where(count > 0, discounted(count, self.d, self.tail) / self.total, self.unknown)


#: Sums of logarithms travel as multiples of 2**-32: exact to 1e-10 and well compressed.
FINE = 2.0**32


def _deal_pairs(uni: Unigrams, first: dict[int, int], parts: int, hot: int):
    """Per block: a row of its documents' sums, and its pairs dealt out by context (pairs of hot contexts by pair).

    ``first``: the number of the first word of each range of hashes.
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[int, int, bytes]] = []
        got = sorted(zip(right["part"].to_pylist(), right["data"].to_pylist()))
        for block, data in zip(left["block"].to_pylist(), left["data"].to_pylist()):
            d = thaw(data)
            back = [(p, thaw(z)) for p, z in got]
            total = np.concatenate([b["total"].astype(np.int64) for _, b in back])
            number = np.concatenate([first[p] + np.cumsum(b["rank"], dtype=np.int64) for p, b in back])
            tokens, sizes = d["tokens"].astype(np.int32), d["sizes"].astype(np.int64)
            doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
            c = total[tokens]
            base = np.bincount(doc, np.log10((c + 1) / (uni.total + uni.types + 1)), len(sizes))
            known = np.bincount(doc[c > 0], minlength=len(sizes))
            # A document's first token follows the end token, as its neighbour's last.
            before = np.concatenate([d["end"].astype(np.int32), tokens[:-1]])
            context = np.bincount(doc, -np.log10(np.maximum(total[before], 1)), len(sizes))
            out.append((-1, block, freeze(ids=d["ids"], null=d["null"], n=sizes, known=known, base=base, context=context)))
            of_word = _part(number.view(np.uint64), parts)
            to = of_word[before]
            warm = np.flatnonzero(total[before] >= hot)
            with np.errstate(over="ignore"):
                pair = number[before[warm]].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + number[tokens[warm]].view(np.uint64)
            to[warm] = _part(pair, parts)
            order = np.lexsort((tokens, before, to))  # a block's words are in the order of their numbers
            cut = np.searchsorted(to[order], np.arange(parts + 1))
            for q, i, j in zip(range(parts), cut, cut[1:]):
                if j == i:
                    continue
                at = order[i:j]
                v, run_ = np.unique(before[at], return_counts=True)
                w, w_at = np.unique(tokens[at], return_inverse=True)
                part = freeze(
                    v=_steps(number[v]), v_n=_small(total[v]), v_run=_small(run_), w=_steps(number[w]), w_n=_small(total[w]),
                    w_at=_small(w_at), doc=_small(doc[at]), train=d["train"],
                )
                out.append((q, block, part))
        return pa.table({"q": pa.array([r[0] for r in out], pa.int32()), "block": pa.array([r[1] for r in out], pa.int64()), "data": pa.array([r[2] for r in out], pa.binary())})

    return run


def _count_pairs(uni: Unigrams, k: int, tail: float, hot: int):
    """A part's pairs → rows of documents' sums per block (kind 0), pairs that backed off from hot contexts (1),
    counts of counts (2) and hot contexts (3); documents' own rows pass (4)."""

    def run(table: pa.Table) -> pa.Table:
        if table["q"][0].as_py() < 0:
            return pa.table({"kind": pa.array([4] * len(table), pa.int32()), "block": table["block"], "data": table["data"]})
        rows = [thaw(z) for z in table["data"].to_pylist()]
        blocks = table["block"].to_pylist()

        def numbered(name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
            """(numbers, their counts, place of each block's words among them, where each block's begin)."""
            own = [np.cumsum(r[name], dtype=np.int64) for r in rows]
            number, at = np.unique(np.concatenate(own), return_inverse=True)
            n = np.zeros(len(number), np.int64)
            n[at] = np.concatenate([r[f"{name}_n"].astype(np.int64) for r in rows])
            return number, n, at.astype(np.int32), np.cumsum([0, *map(len, own)])

        v_word, v_n, v_at, v_first = numbered("v")
        w_word, w_n, w_at, w_first = numbered("w")
        v = np.concatenate([np.repeat(v_at[v_first[i] : v_first[i + 1]], r["v_run"].astype(np.int64)) for i, r in enumerate(rows)])
        w = np.concatenate([w_at[w_first[i] + r["w_at"].astype(np.int64)] for i, r in enumerate(rows)])
        train = np.concatenate([r["train"][r["doc"]] for r in rows]).astype(bool)
        pair, pair_at = np.unique(v.astype(np.int64) * len(w_word) + w, return_inverse=True)
        count = np.bincount(pair_at, train, len(pair)).astype(np.int64)
        r = count[pair_at]
        del pair_at, train
        of_counts = np.bincount(np.minimum(count, k + 2), minlength=k + 3)[1 : k + 2]
        # Per context: how many followers were seen r times (the last column: more than k), and their unigram mass.
        seen = np.flatnonzero(count)
        pv, pw, count = pair[seen] // len(w_word), pair[seen] % len(w_word), count[seen]
        by_count = np.bincount(pv * (k + 1) + np.minimum(count, k + 1) - 1, minlength=len(v_word) * (k + 1)).reshape(-1, k + 1)
        mass = np.bincount(pv, uni.prob(w_n)[pw], len(v_word))
        # What a pair adds whatever the discounts: log(count) above k, log P(w) - log(1 - mass) if it wasn't seen.
        fixed = np.zeros(len(r))
        fixed[r > k] = np.log10(r[r > k] - tail)
        lost = r == 0
        is_hot = v_n >= hot
        rest = np.where((v_n > 0) & ~is_hot, np.log10(np.maximum(1 - mass, 1e-300)), 0.0)
        fixed[lost] = np.log10(uni.prob(w_n))[w[lost]] - rest[v[lost]]
        # Contexts alike in their followers' counts are one kind.
        kinds, kind_of = np.unique(by_count, axis=0, return_inverse=True)
        kind_of = kind_of.reshape(-1)
        out: list[tuple[int, int | None, bytes]] = []
        start = 0
        for block, row in zip(blocks, rows):
            end = start + len(row["doc"])
            doc, rr, vv = row["doc"].astype(np.int64), r[start:end], v[start:end]
            n = len(row["train"])
            sums = {"fixed": np.rint(np.bincount(doc, fixed[start:end], n) * FINE).astype(np.int64)}
            for c in range(1, k + 1):
                sums[f"n{c}"] = _small(np.bincount(doc[rr == c], minlength=n))
            off = (rr == 0) & (v_n[vv] > 0) & ~is_hot[vv]
            used, local = np.unique(kind_of[vv[off]], return_inverse=True)
            sums |= {"off_doc": _small(doc[off]), "off_kind": _small(local), "kinds": _small(kinds[used].reshape(-1))}
            out.append((0, block, freeze(**sums)))
            warm = (rr == 0) & is_hot[vv]
            if warm.any():
                key, times = np.unique(doc[warm] * len(v_word) + vv[warm], return_counts=True)
                out.append((1, block, freeze(doc=_small(key // len(v_word)), v=v_word[key % len(v_word)], n=_small(times))))
            start = end
        out.append((2, None, freeze(counts=of_counts.astype(np.int64))))
        if is_hot.any():
            out.append((3, None, freeze(v=v_word[is_hot], mass=mass[is_hot], **{f"c{c}": _small(by_count[is_hot, c]) for c in range(k + 1)})))
        return pa.table({"kind": pa.array([o[0] for o in out], pa.int32()), "block": pa.array([o[1] for o in out], pa.int64()), "data": pa.array([o[2] for o in out], pa.binary())})

    return run


def _rows_of(df: DataFrame, schema: str, names: list[str]) -> DataFrame:
    """Frozen arrays as plain rows; ``block`` goes first if it is asked for."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for block, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                d = thaw(data)
                n = len(d[names[-1]])
                cols = [np.full(n, block or 0, np.int64) if c == "block" else d[c].view(np.int64) if d[c].dtype == np.uint64 else d[c] for c in names]
                yield pa.RecordBatch.from_arrays([pa.array(c if c.dtype == np.float64 else c.astype(np.int64)) for c in cols], names)

    return df.select("block", "data").mapInArrow(run, schema)


def score(
    spark: SparkSession, docs: DataFrame, train: Column, id_col: str = "doc_id", text: str = "text", params: KatzParams = KatzParams()
) -> DataFrame:
    """One row per input row: ``id_col, n_tokens, n_known, train_tokens, train_types, base_score, score``.

    ``train`` (over the columns of ``docs``) marks the rows to learn from. ``base_score`` is the
    add-one unigram score, ``score`` the model's; both are log10 probabilities of the whole text
    with its end token. Null and empty texts are their end token alone. Ids are integers or null,
    and repeated rows count as often as they come. Without training rows every token is unknown
    (probability one of the one type) and the score is 0.
    """
    p = params
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    blocks = written(spark, _blocks(src, p), "katz_blocks")
    size = blocks.agg(F.coalesce(F.sum("n_words"), F.lit(0)), F.coalesce(F.sum("n_tokens"), F.lit(0))).first()
    parts, pair_parts = max(1, -(-size[0] // p.part_words)), max(1, -(-size[1] // p.part_pairs))

    counted = _split_vocabulary(blocks, parts).groupBy("part").applyInArrow(_sum_vocabulary(p.k), "part int, block long, data binary")
    counted = written(spark, counted, "katz_words")
    own = {r.part: thaw(r.data) for r in counted.where("block IS NULL").select("part", "data").collect()}  # a few numbers per part
    stats = sum((d["stats"] for d in own.values()), np.zeros(p.k + 3, np.int64))
    first, words = {}, 1
    for part in sorted(own):
        first[part] = words
        words += int(own[part]["words"][0])
    d1 = discounts(stats[2:], p.k)
    total, types = int(stats[0]), int(stats[1])
    low = sum(stats[1 + r] * r * (1 - d1[r - 1]) for r in range(1, p.k + 1))
    high = types - int(stats[2 : 2 + p.k].sum())
    uni = Unigrams(total, types, d1, p.tail, float((low + p.tail * high) / total) if total else 1.0)

    asked = counted.where("block IS NOT NULL")
    hot = max(20_000, total // (8 * pair_parts))
    dealt = (
        blocks.select("block", "data")
        .groupBy("block")
        .cogroup(asked.select(F.col("block").alias("b"), "part", "data").groupBy("b"))
        .applyInArrow(_deal_pairs(uni, first, pair_parts, hot), "q int, block long, data binary")
    )
    found = dealt.groupBy("q", F.when(F.col("q") < 0, F.col("block"))).applyInArrow(
        _count_pairs(uni, p.k, p.tail, hot), "kind int, block long, data binary"
    )
    return _finish(spark, written(spark, found, "katz_counts"), uni, p, id_col)


def _finish(spark: SparkSession, found: DataFrame, uni: Unigrams, p: KatzParams, id_col: str) -> DataFrame:
    counts = sum((thaw(r.data)["counts"] for r in found.where("kind = 2").select("data").collect()), np.zeros(p.k + 1, np.int64))
    d2 = discounts(counts, p.k)
    # What a context's followers leave, by how many were seen 1 to k times and more often.
    leaves = np.append(np.arange(1, p.k + 1) * (1 - d2), p.tail)

    lost = _rows_of(found.where("kind = 1"), "block long, doc long, v long, n long", ["block", "doc", "v", "n"])
    cs = [f"c{c}" for c in range(p.k + 1)]
    contexts = _rows_of(found.where("kind = 3"), "v long, mass double, " + ", ".join(f"{c} long" for c in cs), ["v", "mass", *cs])
    left_over = sum((F.col(c) * float(x) for c, x in zip(cs[1:], leaves[1:])), F.col(cs[0]) * float(leaves[0]))
    alpha = (
        contexts.groupBy("v")
        .agg(F.sum("mass").alias("mass"), *[F.sum(c).alias(c) for c in cs])
        .select("v", (F.log10(left_over) - F.log10(1 - F.col("mass"))).alias("alpha"))
    )
    backed = lost.join(alpha, "v").groupBy("block", "doc").agg(F.sum(F.col("n") * F.col("alpha")).alias("backed"))

    def per_document(left: pa.Table, right: pa.Table) -> pa.Table:
        cols: dict[str, list] = {c: [] for c in ("block", "doc", "id", "n_tokens", "n_known", "base_score", "seen_score")}
        for block, data in zip(left["block"].to_pylist(), left["data"].to_pylist()):
            d = thaw(data)
            s = d["context"].copy()
            for z in right["sums"].to_pylist():
                e = thaw(z)
                s += e["fixed"] / FINE + sum(e[f"n{c}"] * np.log10(d2[c - 1] * c) for c in range(1, p.k + 1))
                if len(e["off_doc"]):
                    of_kind = np.log10(e["kinds"].reshape(-1, p.k + 1) @ leaves)
                    s += np.bincount(e["off_doc"], of_kind[e["off_kind"]], len(s))
            cols["block"] += [block] * len(s)
            cols["doc"] += range(len(s))
            cols["id"] += [None if x else int(i) for i, x in zip(d["ids"], d["null"])]
            cols["n_tokens"] += d["n"].tolist()
            cols["n_known"] += d["known"].tolist()
            cols["base_score"] += d["base"].tolist()
            cols["seen_score"] += s.tolist()
        return pa.table({c: pa.array(x, pa.float64() if c.endswith("score") else pa.int64()) for c, x in cols.items()})

    # Both sides come from one table: names of their own keep pruned columns apart.
    sums = found.where("kind = 0").select(F.col("block").alias("b"), F.col("data").alias("sums"))
    docs = (
        found.where("kind = 4").select("block", "data").groupBy("block").cogroup(sums.groupBy("b"))
        .applyInArrow(per_document, "block long, doc long, id long, n_tokens long, n_known long, base_score double, seen_score double")
    )
    return docs.join(backed, ["block", "doc"], "left").select(
        F.col("id").alias(id_col),
        "n_tokens",
        "n_known",
        F.lit(uni.total).cast("long").alias("train_tokens"),
        F.lit(uni.types).cast("long").alias("train_types"),
        "base_score",
        (F.col("seen_score") + F.coalesce("backed", F.lit(0.0))).alias("score"),
    )


def trained_on(id_col: str, folds: int, left_out: int) -> Column:
    """The rows to learn from: those whose remainder isn't ``left_out``; rows without an id are learned from."""
    return F.coalesce(crc_mod(id_col, folds) != left_out, F.lit(True))
