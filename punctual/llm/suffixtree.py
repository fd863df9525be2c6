"""Language-model scores from a probabilistic suffix tree over words, held in distributed tables.

A text is its words, lower-cased, and one end; words are the tree's symbols. Its
states are contexts of no word up to three words before a symbol, across all the
text. Each is judged against its longest proper suffix: a symbol is kept at a
context if it follows often enough, and so much oftener than the suffix's
distribution expects that the divergence (the symbol's term of the Poisson
deviance) reaches ``TELLING``. A context is a state if it keeps a symbol. At a
state a kept symbol has its discounted share, and what is left of the
probability goes to the other symbols as the suffix deals it (Katz), so every
state's distribution sums to one. A symbol is scored in the longest suffix of
its past that is a state. The root is the add-one unigram model, whose unseen
words are one symbol.

Counts cover every training word, and states are as many as the corpus has:
nothing of the tree is collected, but for the few contexts that are too common
for a task. Workers turn texts to chunks of word numbers. A chunk asks for the
counts of its distinct words; then sends its distinct pairs of words, each to
the bucket of the word that is the context, which sees all of it and answers.
Contexts of two and three words are grown only where each of their words stands
out behind the one before, and go to the bucket of their last two words, which
holds the whole branch of the tree above them.

Buckets are numbered by the bytes of text alone and taken one by one, so a task
never holds more than one. A context beyond ``HOT`` words is dealt out by symbol.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.llm.common import U64, bounded_batches, bucket_runs, by_bucket, chunks, discard, hashed, mix, pack, remainder, shuffle_partitions, spans_by, spread, squeeze, texts_of, written, written_at

#: Divergence, in nats, that keeps a symbol; how often it must follow; what is taken off its count.
TELLING, LEAST, DISCOUNT = 12.0, 2, 0.75
#: Bytes of text that are coded together, and that make up a bucket.
CHUNK, BUCKET_BYTES = 3 << 20, 8 << 20
#: Occurrences, and share of all, from which a context is dealt out by symbol: there are at most 100,000 such contexts.
HOT, HOT_SHARE = 2_000_000, 1e-5
#: The end of a text, and all symbols that no context can keep, as keys of symbols.
END_KEY, OTHER = 0xE0D, 0
_KEY = U64((1 << 48) - 1)
#: Entries and answers have log10 probabilities in steps of 1/5000, symbols by 24 bits, and contexts of three words by 32 bits beside those of two.
STEP, _SYMBOL, _LONGER = 5000, U64((1 << 24) - 1), U64((1 << 32) - 1)

ROWS = "chunk long, bucket int, a binary, b binary, c binary, d binary, e binary, x long, y long"
_KINDS = {"chunk": pa.int64(), "bucket": pa.int32(), **dict.fromkeys("abcde", pa.binary()), "x": pa.int64(), "y": pa.int64()}
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


@dataclass
class Root:
    """Training totals: tokens, distinct tokens, ends; and the contexts that are dealt out by symbol, by key, with their counts."""

    total: int
    distinct: int
    ends: int
    hot: np.ndarray
    hot_n: np.ndarray

    def logp(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 1) / (self.total + self.distinct + 1))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    """Rows of the first columns that they have; the rest are null."""
    columns = zip(*((*r, *([None] * (len(_KINDS) - len(r)))) for r in rows), strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS.values(), strict=True)], names=list(_KINDS))


def _encoded(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """For each chunk: its texts as numbers of its distinct words (bucket null), and those words with their training counts, dealt to buckets."""
    for batch in chunks(batches, limit=CHUNK):
        ids = batch.column(0).cast(pa.int64())
        held = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
        index: dict[bytes, int] = {}
        own = [np.array([index.setdefault(w, len(index)) for w in text.lower().split()], np.int32) for text in texts_of(batch)]
        n_words = np.array([len(x) for x in own], np.int64)
        seq = np.concatenate([np.zeros(0, np.int32), *own])
        # Common words have small numbers, which take less room.
        order = np.argsort(-np.bincount(seq, minlength=len(index)), kind="stable")
        number = np.empty(len(order), np.int32)
        number[order] = np.arange(len(order), dtype=np.int32)
        spelled = list(index)
        words, seq = [spelled[i] for i in order.tolist()], number[seq] if len(seq) else seq
        train = np.bincount(seq[np.repeat(~held, n_words)], minlength=len(words)).astype(np.int32)
        valid = ids.is_valid().to_numpy(zero_copy_only=False)
        head = np.r_[ids.fill_null(0).to_numpy(), held.astype(np.int64), valid.astype(np.int64), n_words]
        blob = b"\n".join(words)
        mark = int(hashed([blob + head.tobytes() + seq.tobytes()])[0].view(np.int64))
        rows = [(mark, None, squeeze(head), squeeze(np.frombuffer(blob, np.uint8)), squeeze(seq))]
        if words:
            rows += [(mark, int(b), squeeze(np.frombuffer(b"\n".join([words[i] for i in at.tolist()]), np.uint8)), squeeze(train[at])) for b, at in zip(*_dealt(words, buckets), strict=True)]
        yield _batch(rows)


def _dealt(words: list[bytes], buckets: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The buckets of a chunk's words, and the places of each bucket's words."""
    number, blobs = pack(hashed(words), buckets, {"at": np.arange(len(words), dtype=np.int32)})
    return number, [np.frombuffer(x, np.int32) for x in blobs["at"]]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Total counts of a bucket's words, as answers to the chunks; and (chunk null) the bucket's sums and commonest words."""
    for run in bucket_runs(batches):
        rows = run.to_pylist()
        words = [w for r in rows for w in spread(r["a"], np.uint8).tobytes().split(b"\n")]
        asked = [spread(r["b"], np.int32) for r in rows]
        n, keys = np.concatenate(asked).astype(np.int64), hashed(words)
        order = np.argsort(keys, kind="stable")
        at, of = spans_by(keys[order])
        total = np.add.reduceat(n[order], at)
        back = np.empty(len(keys), np.int64)
        back[order] = total[of]
        ends = np.cumsum([len(x) for x in asked])
        out = [(r["chunk"], r["bucket"], squeeze(back[e - len(x) : e])) for r, x, e in zip(rows, asked, ends.tolist(), strict=True)]
        hot = total >= HOT
        yield _batch([*out, (None, None, squeeze(keys[order][at][hot] & _KEY), squeeze(total[hot]), None, None, None, int((total > 0).sum()), int(total.sum()))])


@dataclass
class Texts:
    """A chunk's texts as positions, each a symbol and the word before it (-1 at a text's start)."""

    ids: np.ndarray
    held: np.ndarray
    valid: np.ndarray
    n_words: np.ndarray
    symbol: np.ndarray
    before: np.ndarray
    doc: np.ndarray
    count: np.ndarray
    key: np.ndarray
    root: np.ndarray

    @property
    def train(self) -> np.ndarray:
        return ~self.held[self.doc]


def _texts(r: dict, answers: dict[int, bytes], buckets: int, root: Root) -> Texts:
    """A chunk's row with the counts of its words; the symbol behind the last word is the end."""
    ids, held, valid, n_words = spread(r["a"], np.int64).reshape(4, -1)
    blob = spread(r["b"], np.uint8).tobytes()
    words = blob.split(b"\n") if blob else []
    count = np.zeros(len(words) + 1, np.int64)
    for bucket, at in zip(*_dealt(words, buckets), strict=True) if words else ():
        count[at] = spread(answers[int(bucket)], np.int64)
    count[-1] = root.ends
    ends = np.cumsum(n_words + 1) - 1
    symbol = np.full(int((n_words + 1).sum()), len(words), np.int64)
    inner = np.ones(len(symbol), bool)
    inner[ends] = False
    symbol[inner] = spread(r["c"], np.int32)
    before = np.r_[-1, symbol[:-1]][: len(symbol)]
    before[ends - n_words] = -1
    key = np.r_[hashed(words), np.array([END_KEY], U64)] & _KEY
    return Texts(ids, held == 1, valid == 1, n_words, symbol, before, np.repeat(np.arange(len(ids)), n_words + 1), count, key, root.logp(count))


@dataclass
class Entries:
    """A chunk's distinct pairs of a context and a symbol, in the order of their buckets; ``of`` is each position's entry (-1: none)."""

    bucket: np.ndarray
    context: np.ndarray
    symbol: np.ndarray
    back: np.ndarray
    n: np.ndarray
    of: np.ndarray

    def rows(self, chunk: int) -> list[tuple]:
        """A row for each bucket: contexts, how many entries each has, then the entries' columns."""
        at, _ = spans_by(self.bucket)
        out = []
        for a, b in zip(at.tolist(), [*at[1:].tolist(), len(self.bucket)], strict=False):
            runs = self.runs(a, b)
            sizes = np.diff(np.r_[runs, b - a]).astype(np.int32)
            out.append((chunk, int(self.bucket[a]), squeeze(self.contexts(a + runs)), squeeze(sizes), squeeze(self.symbol[a:b]), squeeze(self.back[a:b]), squeeze(self.n[a:b])))
        return out

    def runs(self, a: int, b: int) -> np.ndarray:
        return spans_by(self.context[a:b])[0]

    def contexts(self, at: np.ndarray) -> np.ndarray:
        return self.context[at]


def _stepped(logp: np.ndarray) -> np.ndarray:
    return np.clip(np.round(-STEP * logp), 0, 65535).astype(np.uint16)


def _pairs(t: Texts, buckets: int, root: Root) -> Entries:
    """Pairs of a word and the symbol behind it. Words seen once are no context; symbols seen once are one, that nothing keeps."""
    at = np.flatnonzero(t.before >= 0)
    at = at[t.count[t.before[at]] >= LEAST]
    width = len(t.key) + 1
    kept = np.where(t.count[t.symbol[at]] >= LEAST, t.symbol[at], width - 1)
    code, inverse = np.unique(t.before[at] * width + kept, return_inverse=True)
    n = np.bincount(inverse, weights=t.train[at], minlength=len(code)).astype(np.int32)
    context, symbol = t.key[code // width], np.r_[t.key, np.array([OTHER], U64)][code % width]
    back = _stepped(np.r_[t.root, 0.0][code % width])
    dealt = mix(np.where(np.isin(context, root.hot), context ^ mix(symbol), context)) % U64(buckets)
    order = np.lexsort((symbol, context, dealt))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    of = np.full(len(t.symbol), -1, np.int64)
    of[at] = place[inverse]
    return Entries(dealt[order].astype(np.int64), context[order], (symbol[order] & _SYMBOL).astype(np.uint32), back[order], n[order], of)


def judged(context: np.ndarray, symbol: np.ndarray, back: np.ndarray, n: np.ndarray, sizes: dict[int, int] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple[np.ndarray, ...]]:
    """Which entries are kept; the log10 of each entry's probability if it is, and of the factor on the suffix's where it isn't.

    All entries of a context must be here, or else ``sizes`` has its occurrences;
    the sums of such contexts come last: (context, probability kept, the suffix's).
    Entries with the symbol ``OTHER`` are never kept.
    """
    kept, value, factor = np.zeros(len(context), bool), np.zeros(len(context)), np.zeros(len(context))
    if not len(context):
        return kept, value, factor, (context, value, value)
    order = np.lexsort((back, symbol, context))
    c, s, p, times = context[order], symbol[order], 10.0 ** back[order].astype(np.float64), n[order].astype(np.float64)
    new = np.r_[True, (c[1:] != c[:-1]) | (s[1:] != s[:-1]) | (back[order][1:] != back[order][:-1])]
    first = np.flatnonzero(new)
    pair = np.cumsum(new) - 1
    together, p, own = np.add.reduceat(times, first), p[first], c[first]
    at, group = spans_by(own)
    size = np.add.reduceat(together, at)
    split = np.zeros(len(at), bool)
    if sizes:
        known = np.array([sizes.get(int(k), -1) for k in own[at].tolist()], np.float64)
        split = known >= 0
        size = np.where(split, known, size)
    expected = size[group] * p
    with np.errstate(divide="ignore", invalid="ignore"):
        far = together * np.log(together / expected) - together + expected
    good = (together >= LEAST) & (together > expected) & (far >= TELLING) & (s[first] != OTHER)
    share = np.where(good, (together - DISCOUNT) / np.maximum(size[group], 1), 0.0)
    mass, lost = np.add.reduceat(share, at), np.add.reduceat(np.where(good, p, 0.0), at)
    rest = _rest(mass, lost)
    rest[split] = 0.0
    kept[order], value[order], factor[order] = good[pair], np.log10(np.maximum(share, 1e-300))[pair], rest[group][pair]
    return kept, value, factor, (own[at][split], mass[split], lost[split])


def _rest(mass: np.ndarray, lost: np.ndarray) -> np.ndarray:
    """log10 of the factor on the suffix's probability of symbols that are not kept."""
    return np.log10(np.maximum(1 - mass, 1e-12) / np.maximum(1 - lost, 1e-12))


def _entries(rows: list[dict], columns: int) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Of a bucket's rows: each row's runs, and the entries' contexts (one array for each of ``columns``), symbols, log10 probabilities and counts."""
    runs = [spread(r["b"], np.int32) for r in rows]
    heads = [spread(r["a"], U64).reshape(columns, -1) for r in rows]
    contexts = [np.concatenate([np.repeat(h[i], x) for h, x in zip(heads, runs, strict=True)]) for i in range(columns)]
    symbol, back, n = (np.concatenate([spread(r[k], kind) for r in rows]) for k, kind in (("c", np.uint32), ("d", np.uint16), ("e", np.int32)))
    return runs, contexts, symbol, back / -STEP, n


def _judge_pairs(batches: Iterator[pa.RecordBatch], root: Root) -> Iterator[pa.RecordBatch]:
    """Answers to a bucket's pairs: which are kept, the values of those, and the factor of each context; and (chunk null) the sums of contexts dealt out by symbol."""
    sizes = dict(zip(root.hot.tolist(), root.hot_n.tolist(), strict=True))
    for run in bucket_runs(batches):
        rows = run.to_pylist()
        runs, (context,), symbol, back, n = _entries(rows, 1)
        kept, value, factor, sums = judged(context, symbol, back, n, sizes)
        out, a = [], 0
        for r, own in zip(rows, runs, strict=True):
            b = a + int(own.sum())
            first = a + np.cumsum(own) - own
            out.append((r["chunk"], r["bucket"], None, squeeze(np.packbits(kept[a:b])), squeeze(_stepped(value[a:b][kept[a:b]])), squeeze(_stepped(factor[first]))))
            a = b
        yield _batch([*out, (None, None, squeeze(sums[0]), squeeze(sums[1]), squeeze(sums[2]))])


def _told(pairs: Entries, answers: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs of a chunk are kept, and each one's value, or else its factor."""
    own = {x["bucket"]: x for x in answers if x["a"] is None}
    kept, value = np.zeros(len(pairs.bucket), bool), np.zeros(len(pairs.bucket))
    at, _ = spans_by(pairs.bucket)
    for a, b in zip(at.tolist(), [*at[1:].tolist(), len(pairs.bucket)], strict=False):
        r = own[int(pairs.bucket[a])]
        good = np.unpackbits(spread(r["b"], np.uint8), count=b - a).astype(bool)
        _, group = spans_by(pairs.context[a:b])
        found = spread(r["d"], np.uint16)[group] / -STEP
        found[good] = spread(r["c"], np.uint16) / -STEP
        kept[a:b], value[a:b] = good, found
    return kept, value


def _chunk_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, list[dict]]]:
    """Each chunk's row with the answers to it, from rows sorted by chunk, its row last."""
    chunk, answers = None, []
    for batch in batches:
        for r in batch.to_pylist():
            if r["chunk"] != chunk:
                chunk, answers = r["chunk"], []
            if r["bucket"] is None:
                yield r, answers
            else:
                answers.append(r)


def _asked_pairs(batches: Iterator[pa.RecordBatch], buckets: int, root: Root) -> Iterator[pa.RecordBatch]:
    """The pairs of each chunk, dealt to buckets."""
    for r, answers in _chunk_runs(batches):
        t = _texts(r, {x["bucket"]: x["a"] for x in answers}, buckets, root)
        rows = _pairs(t, buckets, root).rows(r["chunk"])
        if rows:
            yield _batch(rows)


def _asked_branches(batches: Iterator[pa.RecordBatch], buckets: int, root: Root, hot: np.ndarray, hot_rest: np.ndarray) -> Iterator[pa.RecordBatch]:
    """For each chunk: what its texts score so far (bucket null), and their contexts of two and three words, dealt to buckets."""
    for r, answers in _chunk_runs(batches):
        t = _texts(r, {x["bucket"]: x["a"] for x in answers if x["a"] is not None}, buckets, root)
        pairs = _pairs(t, buckets, root)
        kept, value = _told(pairs, answers)
        if len(hot) and len(value):
            place = np.minimum(np.searchsorted(hot, pairs.context), len(hot) - 1)
            common = (hot[place] == pairs.context) & ~kept
            value[common] = hot_rest[place[common]]
        # The score of each position in contexts of one word, and whether its symbol is kept there.
        score, told, at = t.root[t.symbol].copy(), np.zeros(len(t.symbol), bool), np.flatnonzero(pairs.of >= 0)
        e = pairs.of[at]
        told[at] = kept[e]
        score[at] = np.where(kept[e], value[e], score[at] + value[e])
        branches = _branches(t, score, told, buckets)
        grown = np.flatnonzero(branches.of >= 0)
        doc = lambda x: np.bincount(t.doc, weights=x, minlength=len(t.ids))
        head = np.r_[t.ids, t.held, t.valid, t.n_words + 1, doc(t.count[t.symbol] > 0).round().astype(np.int64)].astype(np.int64)
        rows = [(r["chunk"], None, squeeze(head), squeeze(np.r_[doc(t.root[t.symbol]), doc(score)]), squeeze(t.doc[grown].astype(np.int32)), squeeze(branches.of[grown].astype(np.int32)))]
        yield _batch([*rows, *branches.rows(r["chunk"])])


@dataclass
class Branches(Entries):
    longer: np.ndarray

    def runs(self, a: int, b: int) -> np.ndarray:
        c, x = self.context[a:b], self.longer[a:b]
        return np.flatnonzero(np.r_[True, (c[1:] != c[:-1]) | (x[1:] != x[:-1])])

    def contexts(self, at: np.ndarray) -> np.ndarray:
        return np.r_[self.context[at], self.longer[at]]


def _branches(t: Texts, score: np.ndarray, told: np.ndarray, buckets: int) -> Branches:
    """Contexts of two words, where the second is kept behind the first, and of three; ``longer`` is 0 where there is none."""
    back = lambda x, k, none: np.concatenate([np.full(min(k, len(x)), none, x.dtype), x[: max(0, len(x) - k)]])
    one, two = back(told, 1, False), back(told, 2, False)
    at = np.flatnonzero(one & (t.before >= 0))
    earlier = back(t.before, 1, -1)  # the word before the word before
    first, second = t.key[earlier[at]], t.key[t.before[at]]
    context = mix(first * U64(3) + mix(second)) & _KEY
    third = back(t.before, 2, -1)[at]
    more = two[at] & (third >= 0) & (earlier[at] >= 0)
    longer = np.where(more, mix(t.key[third] * U64(5) + mix(context)) & _LONGER, U64(0))
    symbol = t.key[t.symbol[at]]
    _, first_of, inverse = np.unique(mix(context ^ mix(longer + U64(7))) + mix(symbol), return_index=True, return_inverse=True)
    n = np.bincount(inverse, weights=t.train[at], minlength=len(first_of)).astype(np.int32)
    context, longer, symbol, known = context[first_of], longer[first_of], symbol[first_of] & _SYMBOL, _stepped(score[at][first_of])
    dealt = (mix(context) % U64(buckets)).astype(np.int64)
    order = np.lexsort((symbol, longer, context, dealt))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    of = np.full(len(t.symbol), -1, np.int64)
    of[at] = place[inverse]
    return Branches(dealt[order], context[order], symbol[order].astype(np.uint32), known[order], n[order], of, longer[order])


def _judge_branches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What contexts of two and three words add to the score of each entry of a bucket."""
    for run in bucket_runs(batches):
        rows = run.to_pylist()
        runs, (context, longer), symbol, back, n = _entries(rows, 2)
        kept, value, factor, _ = judged(context, symbol, back, n)
        score = np.where(kept, value, back + factor)
        at = np.flatnonzero(longer)
        kept, value, factor, _ = judged(mix(context[at] ^ mix(longer[at])), symbol[at], score[at], n[at])
        score[at] = np.where(kept, value, score[at] + factor)
        gain, ends = (score - back).astype(np.float32), np.cumsum([int(x.sum()) for x in runs]).tolist()
        yield _batch([(r["chunk"], r["bucket"], squeeze(gain[a:b])) for r, a, b in zip(rows, [0, *ends], ends, strict=False)])


def _scored(batches: Iterator[pa.RecordBatch], root: Root) -> Iterator[pa.RecordBatch]:
    for r, answers in _chunk_runs(batches):
        ids, held, valid, n_tokens, n_known = spread(r["a"], np.int64).reshape(5, -1)
        base, score = spread(r["b"], np.float64).reshape(2, -1)
        own = {x["bucket"]: x["a"] for x in answers}  # chunks alike have the same answers, each of them
        gain = np.concatenate([np.zeros(0), *(spread(own[b], np.float32) for b in sorted(own))])
        doc, of = spread(r["c"], np.int32), spread(r["d"], np.int32)
        score = score + np.bincount(doc, weights=gain[of], minlength=len(ids))
        columns = [pa.array(ids, mask=valid == 0), pa.array(held == 1), pa.array(n_tokens), pa.array(n_known), pa.array(np.full(len(ids), root.total, np.int64)), pa.array(base), pa.array(score)]
        yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in SCORES.split(", ")])


def score(docs: DataFrame, modulus: int = 7, held: int = 2) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of ``docs`` (doc_id, text).

    Learns from the rows whose remainder isn't ``held``. ``base_score`` is the
    add-one unigram score of the tokens, ``score`` the tree's log10 probability of
    the text. A null text is an empty one: one token, the end. Repeated rows
    count and are scored one by one; other columns are ignored.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (remainder(F.col("doc_id"), modulus) == held).alias("held_out"), "text")
    ends, size = rows.agg(F.count_if(~F.col("held_out")), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    buckets = -(-size // BUCKET_BYTES) or 1
    tasks = min(buckets, shuffle_partitions(spark))

    def by_chunk(*parts: DataFrame) -> DataFrame:
        both = parts[0]
        for part in parts[1:]:
            both = both.union(part)
        return both.repartition(tasks, "chunk").sortWithinPartitions("chunk", F.col("bucket").asc_nulls_last())

    def told(df: DataFrame, *kinds: type) -> list[list[np.ndarray]]:
        """What buckets report of contexts that are dealt out by symbol: at most 100,000 of them."""
        found = df.where("chunk is null and octet_length(a) > 8").select("a", "b", "c").collect()
        return [[spread(bytes(r[i]), kind) for i, kind in enumerate(kinds)] for r in found]

    # Tables are deleted once what is made of them is written.
    kind = F.when(F.col("bucket").isNull(), "texts").otherwise("words")
    coded, coded_at = written_at(rows.mapInArrow(lambda it: _encoded(it, buckets), ROWS).withColumn("kind", kind), "kind")
    texts, words = (coded.where(F.col("kind") == k).drop("kind") for k in ("texts", "words"))
    counts, counts_at = written_at(by_bucket(words, tasks).mapInArrow(_counted, ROWS))
    discard(spark, f"{coded_at}/kind=words")
    distinct, total = counts.agg(F.coalesce(F.sum("x"), F.lit(0)), F.coalesce(F.sum("y"), F.lit(0))).first()
    total, distinct = total + ends, distinct + (ends > 0)
    common = told(counts.where(F.col("y") >= HOT), U64, np.int64)
    hot = sorted((int(k), int(n)) for x in common for k, n in zip(*x, strict=True) if n >= max(HOT, HOT_SHARE * total))
    root = Root(total, distinct, ends, np.array([k for k, _ in hot], U64), np.array([n for _, n in hot], np.int64))

    answers = counts.where("chunk is not null")
    asked = by_bucket(by_chunk(texts, answers).mapInArrow(lambda it: _asked_pairs(it, buckets, root), ROWS), tasks)
    pairs, pairs_at = written_at(asked.mapInArrow(lambda it: _judge_pairs(it, root), ROWS))
    hot_keys, hot_rest = _hot_sums(told(pairs, U64, np.float64, np.float64) if hot else [])

    grown = by_chunk(texts, answers, pairs.where("chunk is not null")).mapInArrow(lambda it: _asked_branches(it, buckets, root, hot_keys, hot_rest), ROWS)
    grown = written(grown)
    discard(spark, coded_at, counts_at, pairs_at)
    gains = by_bucket(grown.where("bucket is not null"), tasks).mapInArrow(_judge_branches, ROWS)
    return by_chunk(grown.where("bucket is null"), gains).mapInArrow(lambda it: _scored(it, root), SCORES)


def _hot_sums(parts: list[list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Contexts dealt out by symbol, sorted, and the factor on the suffix's probability at each."""
    if not parts:
        return np.zeros(0, U64), np.zeros(0)
    keys, mass, lost = (np.concatenate([p[i] for p in parts]) for i in range(3))
    unique, of = np.unique(keys, return_inverse=True)
    add = lambda x: np.bincount(of, weights=x, minlength=len(unique))
    return unique, _rest(add(mass), add(lost))
