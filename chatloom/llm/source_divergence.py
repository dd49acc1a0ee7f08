"""How far the sources of a language differ in their words: stripes folded in the mappers.

Each task folds whole documents into hash stripes, one for each term of a language, that hold the term's document
frequency and its count in each source. A task whose stripes grow beyond a bound hands them on and starts anew. The
stripes are sorted and merged by key as a stream, which holds one stripe at a time. A merged stripe is all that a
term's share in any divergence needs, so the divergences of a batch of stripes are summed where they are merged and
only sums meet in the last shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatloom.llm.common import stored

#: Letters stay, those of A-Z in lower case; all other bytes below 128 end a term.
_LETTERS = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in range(256)).lower()
_STRIPE = "lang string, term string, df long, sources array<string>, counts array<long>"
_SHARE = "lang string, source string, part string, item string, value long"
#: Stripe entries that a task holds before it hands them on. Bounds memory, not results.
HELD_ENTRIES = 1_000_000
_UNIT = 1_000_000_000


def _stripe_batch(rows: list[tuple[str, bytes, int, list[str], list[int]]]) -> pa.RecordBatch:
    lang, term, df, sources, counts = zip(*rows) if rows else ((),) * 5
    return pa.RecordBatch.from_arrays(
        [
            pa.array(lang, pa.string()),
            pa.array(term, pa.binary()).cast(pa.string()),
            pa.array(df, pa.int64()),
            pa.array(sources, pa.list_(pa.string())),
            pa.array(counts, pa.list_(pa.int64())),
        ],
        ["lang", "term", "df", "sources", "counts"],
    )


def _handed_on(counts: dict, frequency: dict, rows_at_once: int = 20_000) -> Iterator[pa.RecordBatch]:
    """The stripes of a task. The empty term, which no text has, stands for the (lang, source) groups themselves."""
    for lang, by_source in counts.items():
        stripes: dict[bytes, tuple[list[str], list[int]]] = {b"": (list(by_source), [0] * len(by_source))}
        for source, terms in by_source.items():
            for term, n in terms.items():
                stripe = stripes.get(term)
                if stripe is None:
                    stripe = stripes[term] = ([], [])
                stripe[0].append(source)
                stripe[1].append(n)
        df = frequency[lang]
        rows = []
        for term, (sources, numbers) in stripes.items():
            rows.append((lang, term, df[term], sources, numbers))
            if len(rows) == rows_at_once:
                yield _stripe_batch(rows)
                rows = []
        yield _stripe_batch(rows)


def _folded(held_entries: int):
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, dict[str, Counter]] = {}
        frequency: dict[str, Counter] = {}
        held = 0
        for batch in batches:
            langs, sources, texts = (batch.column(i) for i in range(3))
            for lang, source, text in zip(langs.to_pylist(), sources.to_pylist(), texts.cast(pa.binary())):
                terms = text.as_py().translate(_LETTERS).split()
                stripes = counts.setdefault(lang, {}).setdefault(source, Counter())
                before = len(stripes)
                stripes.update(terms)
                frequency.setdefault(lang, Counter()).update(set(terms))
                held += len(stripes) - before
                if held > held_entries:
                    yield from _handed_on(counts, frequency)
                    counts, frequency, held = {}, {}, 0
        yield from _handed_on(counts, frequency)

    return fold


def _starts(batch: pa.RecordBatch) -> np.ndarray:
    """Whether each row has another key than the one before it; the first row counts as new."""
    lang, term = batch.column(0), batch.column(1)
    new = pc.or_(pc.not_equal(lang[1:], lang[:-1]), pc.not_equal(term[1:], term[:-1]))
    return np.concatenate([[True], new.to_numpy(zero_copy_only=False)])


def _merged(least_documents: int):
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Stripes that arrive sorted by (lang, term), one for each key; those of rare terms end here."""
        key, df, stripe = None, 0, Counter()
        for batch in batches:
            if not batch.num_rows:
                continue
            new = _starts(batch)
            starts, group = np.flatnonzero(new), np.cumsum(new) - 1
            frequency = np.add.reduceat(batch.column(2).to_numpy(), starts)
            terms = batch.column(1)
            # The first group may go on from the batch before and the last one into the next.
            wanted = (frequency >= least_documents) | (pc.equal(terms, "").to_numpy(zero_copy_only=False)[starts])
            wanted[[0, -1]] = True
            kept = np.flatnonzero(wanted[group])
            columns = [c.to_pylist() for c in batch.take(pa.array(kept)).columns]
            rows = []
            for lang, term, n, sources, counts in zip(*columns):
                if (lang, term) != key:
                    if key is not None and (df >= least_documents or not key[1]):
                        rows.append((key[0], key[1].encode(), df, list(stripe), list(stripe.values())))
                    key, df, stripe = (lang, term), 0, Counter()
                df += n
                for source, count in zip(sources, counts):
                    stripe[source] += count
            yield _stripe_batch(rows)
        if key is not None and (df >= least_documents or not key[1]):
            yield _stripe_batch([(key[0], key[1].encode(), df, list(stripe), list(stripe.values()))])

    return merge


def term_stripes(docs: DataFrame, least_documents: int = 30, held_entries: int = HELD_ENTRIES) -> DataFrame:
    """``(lang, term, df, sources, counts)``: one stripe for each term in at least *least_documents* documents of a language.

    One more stripe for each language, of the empty term, lists its sources with zeros, so sources without any term
    are known as well. NULL ``lang``, ``source`` and ``text`` are empty; repeated rows count as often as they are there.
    """
    columns = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    partial = docs.select(*columns).mapInArrow(_folded(held_entries), _STRIPE)
    keyed = partial.repartition("lang", "term").sortWithinPartitions("lang", "term")
    return keyed.mapInArrow(_merged(least_documents), _STRIPE)


def scaled_share(count: np.ndarray, total: np.ndarray, terms: int, smooth: int = 5) -> np.ndarray:
    """``1 + floor(10^9 * (count + smooth) / (total + smooth * terms))``, exactly, while 1000 totals fit into 63 bits.

    The digits come three at a time, so that nothing passes 64 bits.
    """
    part = np.broadcast_to(count + smooth, np.broadcast_shapes(count.shape, np.shape(total))).astype(np.int64)
    whole = np.broadcast_to(np.asarray(total, np.int64) + smooth * terms, part.shape)
    share, rest = np.divmod(part, whole)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, whole)
        share = share * 1000 + digits
    return share + 1


def _shares(lang: str, rows: list, names: list[str], sizes: np.ndarray, terms: int) -> Iterator[pa.RecordBatch]:
    """What some stripes of a language add to its divergences."""
    place = {name: i for i, name in enumerate(names)}
    counts = np.zeros((len(rows), len(names)), np.int64)
    for row, (_, sources, numbers) in enumerate(rows):
        counts[row, [place[s] for s in sources]] = numbers
    own = scaled_share(counts, sizes[None, :], terms)
    common = scaled_share(counts.sum(1), sizes.sum(), terms)[:, None]
    row, column = np.nonzero((counts > 0) & (own > common))
    above = (own - common)[row, column]
    yield _share_batch(lang, [names[i] for i in column], "term", [rows[i][0] for i in row], above)
    for i in range(len(names) - 1):
        apart = np.abs(own[:, i + 1 :] - own[:, i : i + 1]).sum(0)
        others, this = names[i + 1 :], [names[i]] * len(apart)
        yield _share_batch(lang, this + others, "pair", others + this, np.concatenate([apart, apart]))


def _share_batch(lang: str, sources: list[str], part: str, items: list[str], values: np.ndarray) -> pa.RecordBatch:
    n = len(items)
    columns = [pa.array([lang] * n, pa.string()), pa.array(sources, pa.string()), pa.array([part] * n, pa.string())]
    columns += [pa.array(items, pa.string()), pa.array(values, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["lang", "source", "part", "item", "value"])


def _emitted(cells: int = 2_000_000):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang: dict[str, list] = {}
            profiles: dict[str, tuple] = {}
            langs = batch.column(0).to_pylist()
            for i, lang in enumerate(langs):
                if lang not in profiles:
                    sizes = np.array(batch.column(5)[i].as_py(), np.int64)
                    profiles[lang] = batch.column(4)[i].as_py(), sizes, batch.column(6)[i].as_py()
            for lang, *row in zip(langs, *(batch.column(i).to_pylist() for i in (1, 2, 3))):
                by_lang.setdefault(lang, []).append(row)
            for lang, rows in by_lang.items():
                step = max(1, cells // len(profiles[lang][0]))
                for start in range(0, len(rows), step):
                    yield from _shares(lang, rows[start : start + step], *profiles[lang])

    return emit


def source_divergence(
    docs: DataFrame, least_documents: int = 30, top_terms: int = 50, held_entries: int = HELD_ENTRIES
) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: how each source differs from the others of its language, and in what.

    A term's share in a group is ``1 + floor(10^9 * (count + 5) / (total + 5 * kept terms))``. Part ``pair`` has each
    other source with the sum of absolute differences over the kept terms, zero where a language keeps none. Part
    ``term`` has the *top_terms* terms whose share in the source is most above that in the language. Ranks go by value,
    largest first, then by item in byte order. A language with one source has no pairs; an empty table gives no rows.

    The result has a row for each pair of sources of a language, and a stripe an entry for each source at most.
    """
    stripes = stored(term_stripes(docs, least_documents, held_entries), "stripes")
    entries = stripes.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("entry"))
    sizes = entries.groupBy("lang", F.col("entry.sources").alias("source")).agg(F.sum("entry.counts").alias("size"))
    profile = sizes.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", "size"))).alias("groups"))
    terms = stripes.groupBy("lang").agg(F.count_if(F.col("term") != "").alias("terms"))
    profile = stored(
        profile.join(terms, "lang").select(
            "lang", F.col("groups.source").alias("names"), F.col("groups.size").alias("sizes"), "terms"
        ),
        "profile",
    )
    whole = stripes.where("term <> ''").join(profile, "lang")
    whole = whole.select("lang", "term", "sources", "counts", "names", "sizes", "terms")
    shares = whole.mapInArrow(_emitted(), _SHARE)
    # Pairs that differ in nothing, as where no term is kept, have a row too.
    pairs = profile.select("lang", "names", F.explode("names").alias("source")).select(
        "lang", "source", F.lit("pair").alias("part"), F.explode("names").alias("item"), F.lit(0).cast("long").alias("value")
    )
    summed = shares.unionByName(pairs.where("source <> item")).groupBy("lang", "source", "part", "item")
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = summed.agg(F.sum("value").alias("value")).withColumn("rank", F.row_number().over(order))
    return ranked.where((F.col("part") == "pair") | (F.col("rank") <= top_terms))
