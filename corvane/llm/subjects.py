"""Subject areas of documents from clusters of their vectors.

Documents are clustered by bisecting k-means; the leaves get their subjects from
the terms that set them apart, compared with labelled examples. A subject is then a
mixture of leaves: how often a term occurs in it is how often it does in the leaves,
each as far as it is the subject's. Sentences are held against these mixtures, and a
document has the subjects that enough of its sentences are on.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.languages import FUNCTION_WORDS
from corvane.workspace import Workspace, spread

#: Places for hashed terms in sentence models, and in the vectors that are clustered.
TERMS = 1 << 15
DIMS = 1 << 12
#: Languages, the roots of the tree of clusters.
LANGUAGES = sorted(FUNCTION_WORDS)
#: Terms of sentences are told apart by the language of their document.
ALL = len(LANGUAGES) * TERMS
#: Levels of bisection; clusters below this part of their language are not split. A subject of a smaller part shares leaves with others.
LEVELS = 6
LEAST_PART = 0.012
#: Terms in more than this part of a language's documents tell nothing.
COMMON = 0.5
#: Passes over all documents for each level.
PASSES = 2
#: Documents that the first centres of a split are drawn from; they only start the passes.
SEEDS = 4000
#: Least share of a document's sentences on subjects.
SHARE = 0.2
#: Log weight that chance alone may give a term, and least lead of a sentence's first subject, both as a part of the log of the number of subjects.
LEAN = LEAD = 0.26
#: Weight of labelled examples beside the leaves.
LABELLED = 0.3

_SENTENCE = re.compile(r"(?<=[.!?])[\s\"')\]]+|\n+|(?<=[.!?])(?=[A-ZÀ-Þ])")
_WORD = re.compile(r"[^\W\d_]+")
_MARKUP = re.compile(r"</?[a-zA-Z!][^<>]*>|https?://\S+|[`*_#>|\[\](){}]+")


class Terms(dict):
    """Words, remembered: the place, -1 for single letters, and above it a bit for each language whose function word it is."""

    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        spoken = sum(1 << k for k, lang in enumerate(FUNCTION_WORDS) if word in _FUNCTION[lang])
        place = xxhash.xxh3_64_intdigest(word) % TERMS if len(word) > 1 else TERMS
        value = self[word] = place | spoken << 16
        return value


_FUNCTION = {lang: frozenset(words.split()) for lang, words in FUNCTION_WORDS.items()}


def parsed(text: str, terms: Terms) -> tuple[str, list[int], list[list[int]]]:
    """The language with most function words, the places of all words, those of the distinct words of each sentence."""
    hits, every, out = [0] * (1 << len(_FUNCTION)), [], []
    for sentence in _SENTENCE.split(_MARKUP.sub(" ", text)):
        found = [terms[w] for w in _WORD.findall(sentence.lower())]
        for value in found:
            hits[value >> 16] += 1
        places = [p for p in (value & 0xFFFF for value in found) if p < TERMS]
        if places:
            every += places
            out.append(list(dict.fromkeys(places)))
    best, most = "en", 0
    for k, lang in enumerate(_FUNCTION):
        n = sum(hits[mask] for mask in range(len(hits)) if mask >> k & 1)
        if n > most:
            best, most = lang, n
    return best, every, out


def vectors(documents: DataFrame) -> DataFrame:
    """``doc_id, places, counts, lang, words, sizes`` of each document that has words.

    The only pass over the texts: terms with their counts, and the sentences, as the
    distinct terms of all of them in a row and the number of terms of each.
    """

    def run(batches):
        terms = Terms()
        for batch in batches:
            ids, langs, places, counts, words, sizes = [], [], [], [], [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                lang, found, parts = parsed(text, terms)
                if found:
                    distinct, n = np.unique(np.array(found, np.int32), return_counts=True)
                    ids.append(key)
                    langs.append(LANGUAGES.index(lang))
                    places.append(distinct)
                    counts.append(n.astype(np.int32))
                    words.append([t for p in parts for t in p])
                    sizes.append([len(p) for p in parts])
            lists = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(places, lists), pa.array(counts, lists), pa.array(langs, pa.int32()), pa.array(words, lists), pa.array(sizes, lists)], names=["doc_id", "places", "counts", "lang", "words", "sizes"])

    schema = "doc_id long, places array<int>, counts array<int>, lang int, words array<int>, sizes array<int>"
    return spread(documents.filter("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text")).mapInArrow(run, schema)


class Sentences:
    """The sentences of a batch of ``words, sizes, lang``: places below ``ALL`` in a row, their sizes, documents and languages."""

    def __init__(self, words, sizes, lang):
        self.size = sizes.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        self.owner = np.repeat(np.arange(len(sizes)), np.diff(sizes.offsets.to_numpy()))
        self.lang = lang.to_numpy().astype(np.int64)[self.owner]
        flat = words.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        self.flat = flat + np.repeat(self.lang, self.size) * TERMS

    def score(self, weights: np.ndarray) -> np.ndarray:
        if not len(self.size):
            return np.zeros((0, weights.shape[1]), np.float32)
        return np.add.reduceat(weights[self.flat], np.cumsum(self.size) - self.size, axis=0)

    def subjects(self, weights: np.ndarray) -> np.ndarray:
        """Subject of each sentence, the number of subjects where none leads."""
        score = self.score(weights)
        order = np.sort(np.concatenate([score, np.zeros((len(score), 1), np.float32)], axis=1), axis=1)
        sure = order[:, -1] - order[:, -2] > LEAD * np.log(max(2, weights.shape[1]))
        return np.where(sure, score.argmax(axis=1), weights.shape[1])


def _flat(batch, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(language by row; row, full place, folded place, unit-length value of all terms) of a batch."""
    lang = batch.column(3).to_numpy().astype(np.int64)
    lists = batch.column(1)
    places = lists.flatten().to_numpy(zero_copy_only=False)
    counts = batch.column(2).flatten().to_numpy(zero_copy_only=False)
    size = np.diff(lists.offsets.to_numpy())
    row = np.repeat(np.arange(batch.num_rows), size)
    value = (np.log1p(counts) * idf[lang[row], places]).astype(np.float32)
    norm = np.sqrt(np.bincount(row, value**2, batch.num_rows)).astype(np.float32)
    return lang, row, places, places & (DIMS - 1), value / np.maximum(norm[row], 1e-9)


def _assign(lang, row, folded, value, tree: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Node of each row after going down the levels of ``tree`` (children, centres) from its language."""
    node, rows = lang, len(lang)
    for children, centres in tree:
        pair = children[node]  # the first of two children, or the only one, by parent
        two = pair[:, 1] >= 0
        apart = centres[np.maximum(pair[row, 1], 0), folded] - centres[pair[row, 0], folded]
        node = np.where(two & (np.bincount(row, value * apart, rows) > 0), pair[:, 1], pair[:, 0])
    return node


def _summed(table: pa.Table) -> pa.Table:
    """Sum of the partial vectors of one node."""
    total, n = None, 0
    for packed, count in zip(table.column("sums"), table.column("n"), strict=True):
        part = np.frombuffer(packed.as_py(), np.float32)
        total = part.astype(np.float64) if total is None else total + part
        n += count.as_py()
    return pa.table({"node": table.column("node")[:1], "sums": pa.array([total.astype(np.float32).tobytes()], pa.binary()), "n": pa.array([n], pa.int64())})


def _pass(docs: DataFrame, shared_tree, shared_idf, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the vectors and sizes of the last level's nodes."""

    def run(batches):
        sums, sizes = np.zeros(nodes * DIMS, np.float32), np.zeros(nodes, np.int64)
        tree, idf = shared_tree.value, shared_idf.value
        for batch in batches:
            if not batch.num_rows:
                continue
            lang, row, _, folded, value = _flat(batch, idf)
            node = _assign(lang, row, folded, value, tree)
            sums += np.bincount(node[row] * DIMS + folded, value, nodes * DIMS).astype(np.float32)
            sizes += np.bincount(node, None, nodes)
        held = np.nonzero(sizes)[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(held.astype(np.int32)), pa.array([sums[k * DIMS : (k + 1) * DIMS].tobytes() for k in held], pa.binary()), pa.array(sizes[held])], names=["node", "sums", "n"]
        )

    partial = docs.select("doc_id", "places", "counts", "lang").mapInArrow(run, "node int, sums binary, n long")
    merged = partial.groupBy("node").applyInArrow(lambda t: _summed(t), "node int, sums binary, n long")
    out, sizes = np.zeros((nodes, DIMS), np.float32), np.zeros(nodes, np.int64)
    for r in merged.toLocalIterator():
        out[r["node"]] = np.frombuffer(r["sums"], np.float32)
        sizes[r["node"]] = r["n"]
    return out, sizes


def _presence(docs: DataFrame, shared_tree, shared_idf, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents by leaf and term, and sizes of the leaves."""

    def run(batches):
        tree, idf = shared_tree.value, shared_idf.value
        for batch in batches:
            if not batch.num_rows:
                continue
            lang, row, places, folded, value = _flat(batch, idf)
            node = _assign(lang, row, folded, value, tree)
            at, n = np.unique(np.concatenate([node[row] * (TERMS + 1) + places, node * (TERMS + 1) + TERMS]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n)], names=["at", "n"])

    partial = docs.select("doc_id", "places", "counts", "lang").mapInArrow(run, "at long, n long")
    table = partial.groupBy("at").agg(F.sum("n").alias("n")).toArrow()  # leaves times terms, those that occur
    out = np.zeros(nodes * (TERMS + 1), np.float32)
    out[table.column("at").to_numpy()] = table.column("n").to_numpy()
    out = out.reshape(nodes, TERMS + 1)
    return out[:, :TERMS], out[:, TERMS].astype(np.int64)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-9)


def _two_means(x: np.ndarray, rng: np.random.Generator) -> np.ndarray | None:
    """Two centres of a few unit vectors, the best of some starts."""
    best, found = -1.0, None
    if len(x) < 4:
        return None
    for _ in range(6):
        a = x[rng.integers(len(x))]
        far = np.argsort(x @ a)[: max(1, len(x) // 4)]
        centres = np.stack([a, x[rng.choice(far)]])
        for _ in range(8):
            side = (x @ centres.T).argmax(axis=1)
            if side.min() == side.max():
                break
            centres = _unit(np.stack([x[side == 0].sum(axis=0), x[side == 1].sum(axis=0)]))
        fit = float((x @ centres.T).max(axis=1).sum())
        if fit > best:
            best, found = fit, centres
    return found


def bisect(docs: DataFrame, idf: np.ndarray, totals: np.ndarray, seed: int = 11):
    """The levels of the tree of clusters and the language of each leaf; ``totals`` counts documents by language."""
    spark = docs.sparkSession
    rng = np.random.default_rng(seed)
    shared_idf = spark.sparkContext.broadcast(idf)
    each = SEEDS // len(LANGUAGES)
    cuts = F.array(*[F.lit(int(min(1.0, 1.2 * each / max(1, n)) * (1 << 30))) for n in totals])
    code = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30))
    drawn = docs.filter(code < cuts[F.col("lang")]).orderBy(code, "doc_id").limit(2 * SEEDS).select("doc_id", "places", "counts", "lang")
    batches = drawn.toArrow().combine_chunks().to_batches()
    if not batches:
        return [], np.arange(len(LANGUAGES))
    lang, row, _, folded, value = _flat(batches[0], idf)
    sample = np.zeros((len(lang), DIMS), np.float32)
    np.add.at(sample, (row, folded), value)
    tree: list[tuple[np.ndarray, np.ndarray]] = []
    sizes, root = np.asarray(totals), np.arange(len(LANGUAGES))
    for _ in range(LEVELS):
        at = _assign(lang, row, folded, value, tree)
        children, centres, roots = np.full((len(root), 2), -1, np.int64), [], []
        for k in range(len(root)):
            pair = _two_means(sample[at == k], rng) if sizes[k] >= max(8, LEAST_PART * totals[root[k]]) else None
            children[k, 0] = len(centres)
            if pair is None:
                centres.append(np.zeros(DIMS, np.float32))
                roots.append(root[k])
            else:
                children[k, 1] = len(centres) + 1
                centres += [pair[0], pair[1]]
                roots += [root[k], root[k]]
        if len(centres) == len(root):
            break
        level = np.stack(centres).astype(np.float32)
        for _ in range(PASSES):
            shared = spark.sparkContext.broadcast([*tree, (children, level)])
            sums, sizes = _pass(docs, shared, shared_idf, len(level))
            level = np.where(sizes[:, None] > 0, _unit(sums), level).astype(np.float32)
        tree.append((children, level))
        root = np.array(roots)
    return tree, root


def leaf_subjects(presence: np.ndarray, sizes: np.ndarray, examples: np.ndarray) -> np.ndarray:
    """Affinity of each leaf to each subject: how far the terms that set the leaf apart are the subject's.

    ``presence`` is leaf by term, ``examples`` subject by term; rows add to one.
    """
    rate = (presence + 0.1) / (sizes[:, None] + 1.0)
    apart = np.log(rate / ((presence.sum(axis=0) + 0.1) / (sizes.sum() + 1.0))[None, :])
    apart = np.where((presence >= 3) & (apart > 0.7), apart * np.sqrt(rate), 0)
    share = examples / np.maximum(examples.sum(axis=0), 1e-9)[None, :]
    seen = examples.sum(axis=0) > 0
    own = np.where(seen[None, :], np.maximum(share - 2.0 / len(examples), 0), 0)
    score = apart @ own.T
    total = score.sum(axis=1)
    # a leaf whose terms are no subject's, such as one of stock phrases, stays near zero
    sure = total / (total + 0.25 * np.median(total[total > 0])) if (total > 0).any() else total
    score = score**2
    return score / np.maximum(score.sum(axis=1, keepdims=True), 1e-12) * sure[:, None]


def term_weights(presence: np.ndarray, sizes: np.ndarray, affinity: np.ndarray, examples: np.ndarray) -> np.ndarray:
    """Log weight of each term for each subject over its mean; what chance alone may give is cut off.

    A subject is the mixture of leaves that ``affinity`` makes of it: the rate of a term
    in it is the part of documents with the term in the leaves, each leaf as far as it is
    the subject's. Labelled examples weigh in a little, for subjects without a leaf.
    """
    rate = affinity.T @ presence / ((affinity * sizes[:, None]).sum(axis=0) + 5)[:, None]
    seen = presence.sum(axis=0)
    share = rate / np.maximum(rate.sum(axis=0), 1e-12) * seen / (seen + 3)
    labelled, known = examples / np.maximum(examples.sum(axis=1, keepdims=True), 1), examples.sum(axis=0)
    share = share + LABELLED * labelled / np.maximum(labelled.sum(axis=0), 1e-9) * known / (known + 2)
    share = (share + 0.02) / (share + 0.02).sum(axis=0)
    return np.maximum(np.log(share * len(share)) - LEAN * np.log(max(2, len(share))), 0).astype(np.float32)


def fit(documents: DataFrame, examples: DataFrame, workspace: Workspace):
    """Vectors, subject names, weights of terms by subject; None without examples or words."""
    spark = documents.sparkSession
    labelled = [(r["subject"], r["text"]) for r in examples.filter("subject IS NOT NULL AND text IS NOT NULL").select("subject", "text").collect()]  # fixed in number
    names = sorted({s for s, _ in labelled})
    docs = workspace.save(vectors(documents), "vectors")
    total = docs.count()
    if not names or not total:
        return None
    terms = Terms()
    example_counts = np.zeros((len(names), TERMS), np.float64)
    for subject, text in labelled:
        for place in set(parsed(text, terms)[1]):
            example_counts[names.index(subject), place] += 1
    found = docs.select("lang", F.explode("places").alias("p")).groupBy("lang", "p").agg(F.count(F.lit(1)).alias("n")).toArrow()  # languages times TERMS
    frequency, totals = np.zeros((len(LANGUAGES), TERMS)), np.zeros(len(LANGUAGES), np.int64)
    frequency[found.column("lang").to_numpy(), found.column("p").to_numpy()] = found.column("n").to_numpy()
    for row in docs.groupBy("lang").count().collect():
        totals[row["lang"]] = row["count"]
    part = (frequency + 1) / (totals[:, None] + 1)
    idf = np.where((frequency > 1) & (part < COMMON), -np.log(part), 0).astype(np.float32)
    tree, root = bisect(docs, idf, totals)
    leaves = len(root)
    presence, sizes = _presence(docs, spark.sparkContext.broadcast(tree), spark.sparkContext.broadcast(idf), leaves)
    affinity = leaf_subjects(presence, sizes, example_counts)
    weights = np.concatenate([
        term_weights(presence[root == k], sizes[root == k], affinity[root == k], example_counts).T for k in range(len(LANGUAGES))
    ])
    return docs, names, weights


def document_subjects(documents: DataFrame, examples: DataFrame, share: float = SHARE) -> DataFrame:
    """``doc_id, subject, part``: each subject that at least ``share`` of a document's sentences on any subject are on.

    Null, empty and wordless texts and texts on no subject have no rows. Repeated texts
    get the same subjects.
    """
    spark = documents.sparkSession
    schema = "doc_id long, subject string, part double"
    fitted = fit(documents, examples, Workspace(spark, "subjects"))
    if fitted is None:
        return spark.createDataFrame([], schema)
    docs, names, weights = fitted
    shared = spark.sparkContext.broadcast(weights)  # languages times TERMS rows

    def run(batches):
        weights = shared.value
        for batch in batches:
            parts, rows = Sentences(*batch.columns[1:]), batch.num_rows
            kind = parts.subjects(weights)
            held = np.bincount(parts.owner * (len(names) + 1) + kind, None, rows * (len(names) + 1)).reshape(rows, len(names) + 1)[:, :-1]
            on_any = held.sum(axis=1, keepdims=True)
            doc, k = np.nonzero(held >= np.maximum(1, share * on_any - 1e-9))
            part = held[doc, k] / on_any[doc, 0]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc)), pa.array([names[x] for x in k], pa.string()), pa.array(part, pa.float64())], names=["doc_id", "subject", "part"])

    return docs.select("doc_id", "words", "sizes", "lang").mapInArrow(run, schema)
