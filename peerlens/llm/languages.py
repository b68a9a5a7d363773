"""Missing or wrong document language labels.

A multinomial naive Bayes model over hashed character n-grams of words gives
every word a log-probability under each language.  Words of a batch are scored
once each, as sparse rows of n-gram hashes against the broadcast matrix, and a
document is the sequence of its words' scores.  A Viterbi path with a cost for
each change of language cuts mixed documents into stretches; stretches of fewer
than ``shortest`` words (quotations, names) go to their surroundings.

The model is fitted on a bounded sample of labelled documents, balanced over
the languages.  As labels may be wrong, it is fitted again on those sample
documents that the former model gives the same language as the label.  A
language written in two scripts is two classes, joined in the result.
"""

from __future__ import annotations

import heapq
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerlens.llm.topn import top_n_per_group

#: Codes and names of each language, lower case.
NAMES = {
    "en": ["en", "eng", "english", "inglés", "anglais", "englisch"],
    "es": ["es", "spa", "spanish", "español", "espanol", "castellano", "castilian", "esp"],
    "pt": ["pt", "por", "portuguese", "português", "portugues"],
    "fr": ["fr", "fra", "fre", "french", "français", "francais"],
    "de": ["de", "deu", "ger", "german", "deutsch"],
    "id": ["id", "ind", "in", "indonesian", "indonesia", "bahasa"],
    "bn": ["bn", "ben", "bengali", "bangla", "বাংলা"],
    "hi": ["hi", "hin", "hindi", "हिन्दी", "हिंदी"],
}
#: Languages that are written in both Latin and their own letters.
TWO_SCRIPTS = ("bn",)
#: Buckets of n-gram hashes, longest n-gram, and pseudo-count of an n-gram.
BUCKETS, LONGEST_GRAM, SMOOTH = 1 << 16, 4, 0.05
#: Sample documents of each language and script, and the longest of them in characters.
SAMPLE, SAMPLE_CHARS = 1000, 20_000
#: Fits after the first.
REFITS = 3
#: Most that one word can say against a language, and the cost of a change of language, in nats.
WORD_CAP, CHANGE = 6.0, 9.0
#: Words of the shortest stretch that counts.
SHORTEST = 8

#: Code points from here on are ideographs or never used.
_TOP = 0x20000
_LETTER, _MARK, _INNER, _FIGURE, _HASH, _UNSEEN = range(1, 7)
_LINK = regex.compile(r"\b\w+://\S+")
_SITE = regex.compile(r"\bwww\.\S+", regex.I)
_ADDRESS = regex.compile(r"(?<!\S)[^\s@]+@\S+\.\w+")
_TAG = regex.compile(r"</?[\p{L}|!?][^<>]*>")
_ENTITY = regex.compile(r"&#?\w{1,8};")
_RECORD = regex.compile(r"\{\s*\"[^{}]*\}")
_VALUE = regex.compile(r":\s*\"((?:[^\"\\]|\\.)*+)\"")
_EXTENSIONS = ("jpg", "jpeg", "png", "webp", "bmp", "pdf", "json", "csv")
_FILE = regex.compile(rf"(?<![\w-])[\w-]+\.(?:{'|'.join(_EXTENSIONS)})\b", regex.I)
_RUN = regex.compile(r"(.{1,4}?)\1{7,}")
#: Words of more letters are looked at for repetition ("hahaha…"), which makes them no words.
LONG_WORD = 40
#: Characters of texts that are cut into words together.
HELD = 1 << 21


def _kinds() -> np.ndarray:
    """The part in words of each code point below ``_TOP``, and of all others at ``_TOP``."""
    major = {"L": _LETTER, "M": _MARK, "N": _FIGURE}
    out = np.array([major.get(unicodedata.category(chr(i))[0], 0) for i in range(_TOP)] + [_LETTER], np.uint8)
    # Code points inside words that aren't letters, and those that a reader doesn't see.
    out[[0x27, 0x2019, 0x200C, 0x200D]] = _INNER
    out[ord("_")], out[ord("#")] = _FIGURE, _HASH
    unseen = [0x334, 0x335, 0x336, 0x337, 0x338, 0x343, 0x351, 0x36B, 0xAD, 0x200B, 0x200E, 0x200F, *range(0x202A, 0x202F), 0x2060, 0xFEFF]
    out[unseen + [i for i in range(_TOP) if unicodedata.category(chr(i)) == "Me"]] = _UNSEEN
    return out


_KINDS = _kinds()


def _prose(record: regex.Match) -> str:
    """The values of a record that are prose, of two words or more; its keys, codes and figures go."""
    return " ".join(["", *(v for v in _VALUE.findall(record[0]) if len(v.split()) > 1), ""])


def readable(text: str) -> str:
    """The lower-case text without links, markup, records and file names; each is only looked for where its mark is."""
    if "://" in text:
        text = _LINK.sub(" ", text)
    if "<" in text:
        text = _TAG.sub(" ", text)
    if "{" in text:
        text = _RECORD.sub(_prose, text)
    if "@" in text:
        text = _ADDRESS.sub(" ", text)
    if "&" in text:
        text = _ENTITY.sub(" ", text)
    low = text.lower()
    if "www." in low:
        text = _SITE.sub(" ", text)
    if any("." + e in low for e in _EXTENSIONS):
        text = _FILE.sub(" ", text)
    return text.lower() if text.isascii() else unicodedata.normalize("NFKC", text).lower()


@dataclass(frozen=True)
class Words:
    """The words of texts: distinct ones, their numbers in the order of the texts, and how many each text has."""

    distinct: list[str]
    ids: np.ndarray
    counts: np.ndarray


def words_in(texts: list[str | None]) -> Words:
    """Runs of letters, marks and apostrophes that begin with a letter; codes with figures and long repetitions aren't words.

    All texts are cut at once: a table tells each character's part in words,
    and equal words are found by a 64-bit hash of their characters.
    """
    clean = [readable(t) if t else "" for t in texts]
    points = np.frombuffer("\n".join([*clean, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = _KINDS[np.minimum(points, _TOP)]
    stops = np.cumsum([len(t) + 1 for t in clean], dtype=np.int64)
    if (kinds == _UNSEEN).any():
        seen = kinds != _UNSEEN
        stops = np.cumsum(seen)[stops - 1]
        points, kinds = points[seen], kinds[seen]
    inside = (kinds >= _LETTER) & (kinds <= _INNER)
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    begin, end = edges[::2], edges[1::2]
    # A run begins with its first letter: signs before it aren't part of the word.
    letters = np.append(np.flatnonzero(kinds == _LETTER), len(kinds))
    begin = letters[np.searchsorted(letters, begin)]
    whole = begin < end
    begin, end = begin[whole], end[whole]
    around = np.concatenate([[0], kinds, [0]])
    before, after = around[begin], around[end + 1]
    whole = ((before == 0) | (before == _INNER)) & (after != _FIGURE)
    begin, end = begin[whole], end[whole]
    size = end - begin
    if not len(begin):
        return Words([], np.empty(0, np.int64), np.zeros(len(texts), np.int64))
    at = np.repeat(begin, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    powers = np.cumprod(np.full(size.max(), 0xD1342543DE82EF95, np.uint64))
    mixed = (points[at].astype(np.uint64) + np.uint64(0x632BE5AB)) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * powers[at - np.repeat(begin, size)]
    _, first, ids = np.unique(np.add.reduceat(mixed, np.cumsum(size) - size), return_index=True, return_inverse=True)
    text = points.tobytes().decode("utf-32-le", "surrogatepass")
    distinct = [text[a:b] for a, b in zip(begin[first].tolist(), end[first].tolist())]
    runs = np.array([len(w) > LONG_WORD and _RUN.search(w) is not None for w in distinct], bool)
    if runs.any():
        number = np.cumsum(~runs) - 1
        left = ~runs[ids]
        distinct, ids, begin = [w for w, r in zip(distinct, runs) if not r], number[ids[left]], begin[left]
    return Words(distinct, ids, np.diff(np.searchsorted(begin, stops), prepend=0))


def words_of(text: str) -> list[str]:
    """The lower-case words of one text."""
    found = words_in([text])
    return [found.distinct[i] for i in found.ids]


def label_code(label: Column) -> Column:
    """The code that a label names in any spelling, or null."""
    key = F.regexp_extract(F.lower(F.regexp_replace(label, r"^[\s ]+", "")), r"^[\p{L}\p{M}]+", 0)
    pairs = [F.lit(x) for code, names in NAMES.items() for n in names for x in (n, code)]
    return F.create_map(*pairs)[key]


def gram_rows(distinct: list[str], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of all n-grams of the words, word after word, and where each word begins."""
    text = "".join(f" {w} " for w in distinct)
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in distinct], np.int64)
    begin = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(distinct)), sizes)
    at_end = np.zeros(len(points), np.int64)
    at_end[:] = np.repeat(begin + sizes, sizes)
    place = np.arange(len(points))
    rows, owners = [], []
    h = np.zeros(len(points), np.uint64)
    for n in range(1, LONGEST_GRAM + 1):
        part = np.zeros(len(points), np.uint64)
        part[: len(points) - n + 1] = points[n - 1 :]
        h = (h * np.uint64(0x100000001B3)) ^ (part + np.uint64(0x9E3779B9))
        inside = place + n <= at_end
        if n == 1:
            inside &= points != 32
        mixed = h * np.uint64(0x9E3779B97F4A7C15 + 2 * n)
        rows.append((mixed[inside] >> np.uint64(40)) % np.uint64(buckets))
        owners.append(owner[inside])
    rows, owners = np.concatenate(rows).astype(np.int64), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return rows[order], np.searchsorted(owners[order], np.arange(len(distinct)))


@dataclass(frozen=True)
class Model:
    """Log-probabilities (bucket, class) and the language of each class."""

    logs: np.ndarray
    codes: tuple[str, ...]

    def word_scores(self, distinct: list[str]) -> np.ndarray:
        """(word, class): log-likelihood of each word less that of its best class, not below ``-WORD_CAP``."""
        if not distinct:
            return np.empty((0, len(self.codes)), np.float64)
        rows, begin = gram_rows(distinct, len(self.logs))
        score = np.add.reduceat(self.logs[rows], begin, axis=0).astype(np.float64)
        return np.maximum(score - score.max(1, keepdims=True), -WORD_CAP)


def fit(words: Words, labels: list[int], codes: tuple[str, ...], refits: int = REFITS) -> Model:
    """Naive Bayes from documents and their class numbers, fitted again without those it contradicts."""
    rows, begin = gram_rows(words.distinct) if words.distinct else (np.empty(0, np.int64), np.empty(0, np.int64))
    per_word = np.diff(np.append(begin, len(rows)))
    labels_at = np.array(labels, np.int64)
    keep = np.ones(len(labels_at), bool)
    model = Model(np.zeros((BUCKETS, len(codes)), np.float32), codes)
    for _ in range(refits + 1):
        counts = np.full((BUCKETS, len(codes)), SMOOTH)
        for c in range(len(codes)):
            mine = words.ids[np.repeat(keep & (labels_at == c), words.counts)]
            times = np.bincount(mine, minlength=len(words.distinct)).astype(np.float64)
            counts[:, c] += np.bincount(rows, np.repeat(times, per_word), BUCKETS)
        model = Model(np.log(counts / counts.sum(0)).astype(np.float32), codes)
        some = words.counts > 0
        best = np.full(len(labels_at), -1)
        if some.any():
            best[some] = _totals(model.word_scores(words.distinct)[words.ids], words.counts[some]).argmax(1)
        keep = best == labels_at
    return model


def _totals(scores: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The sum of the word scores of each text; every text has words."""
    return np.add.reduceat(scores, np.cumsum(counts) - counts, axis=0)


def mixed_texts(scores: np.ndarray, counts: np.ndarray, change: float = CHANGE) -> tuple[np.ndarray, np.ndarray]:
    """(main class, whether a path with changes may beat it) of each text.

    A text is of one class where no stretch of another class gains more than
    one change costs.  The gains of all texts run in one sum: each text starts
    so far below the one before that a running minimum starts anew with it.
    """
    begin = np.cumsum(counts) - counts
    main = np.add.reduceat(scores, begin, axis=0).argmax(1)
    gain = scores - np.take_along_axis(scores, np.repeat(main, counts)[:, None], 1)
    np.cumsum(gain, axis=0, out=gain)
    base = np.vstack([np.zeros(scores.shape[1]), gain[begin[1:] - 1]])
    down = (2 * WORD_CAP * counts.max() + 1) * np.arange(len(counts))
    gain -= np.repeat(base + down[:, None], counts, axis=0)
    least = np.minimum.accumulate(gain, axis=0)
    np.minimum(least, np.repeat(-down, counts)[:, None], out=least)
    gain -= least
    return main, np.maximum.reduceat(gain.max(1), begin) > change


def best_paths(scores: np.ndarray, counts: np.ndarray, change: float = CHANGE) -> np.ndarray:
    """The class of each word on the best path of each text, by Viterbi steps over all texts at once."""
    order = np.argsort(-counts, kind="stable")
    begin, left = (np.cumsum(counts) - counts)[order], counts[order]
    longest = int(left[0])
    active = len(left) - np.searchsorted(left[::-1], np.arange(longest), "right")
    stay = np.arange(scores.shape[1])
    back = np.empty(scores.shape, np.int8)
    best = scores[begin]
    for i in range(1, longest):
        a = active[i]
        rows, now = begin[:a] + i, best[:a]
        top = now.argmax(1)
        moved = now[np.arange(a), top, None] - change
        back[rows] = np.where(now >= moved, stay, top[:, None])
        best[:a] = np.maximum(now, moved) + scores[rows]
    at = best.argmax(1)
    path = np.empty(len(scores), np.int64)
    for i in range(longest - 1, -1, -1):
        rows = begin[: active[i]] + i
        path[rows] = at[: active[i]]
        if i:
            at[: active[i]] = back[rows, at[: active[i]]]
    return path


def stretches(scores: np.ndarray, change: float = CHANGE, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """(begin, end, class) of the stretches of a document from its word scores (word, class)."""
    if not len(scores):
        return []
    counts = np.array([len(scores)])
    main, mixed = mixed_texts(scores, counts, change)
    return _cut(best_paths(scores, counts, change), scores, shortest) if mixed[0] else [(0, len(scores), int(main[0]))]


def _cut(path: np.ndarray, scores: np.ndarray, shortest: int) -> list[tuple[int, int, int]]:
    """The stretches of a path, none shorter than ``shortest`` unless it is the whole text."""
    cuts = [0, *(np.flatnonzero(np.diff(path)) + 1).tolist(), len(path)]
    return joined([(a, b, int(path[a])) for a, b in zip(cuts, cuts[1:])], scores, shortest)


def joined(parts: list[tuple[int, int, int]], scores: np.ndarray, shortest: int) -> list[tuple[int, int, int]]:
    """The stretches after each short one, the shortest first, went to the neighbour that explains it better.

    Neighbours differ in class.  A heap holds the stretches by length, so a
    text of very many stretches takes little more than one pass.
    """
    begin, end, kind = (list(x) for x in zip(*parts))
    left, right = list(range(-1, len(parts) - 1)), [*range(1, len(parts)), -1]
    alive = [True] * len(parts)
    heap = [(end[i] - begin[i], begin[i], i) for i in range(len(parts))]
    heapq.heapify(heap)
    while heap and heap[0][0] < shortest:
        length, at, i = heapq.heappop(heap)
        if not alive[i] or (end[i] - begin[i], begin[i]) != (length, at):
            continue
        near = [k for k in (left[i], right[i]) if k >= 0]
        if not near:
            break
        total = scores[at : at + length].sum(0)
        kind[i] = kind[max(near, key=lambda k: total[kind[k]])]
        for k in near:
            if kind[k] == kind[i]:
                alive[k] = False
                begin[i], end[i] = min(begin[i], begin[k]), max(end[i], end[k])
                if k == left[i]:
                    left[i] = left[k]
                    if left[k] >= 0:
                        right[left[k]] = i
                else:
                    right[i] = right[k]
                    if right[k] >= 0:
                        left[right[k]] = i
        heapq.heappush(heap, (end[i] - begin[i], begin[i], i))
    return sorted((begin[i], end[i], kind[i]) for i in range(len(parts)) if alive[i])


def training_sample(df: DataFrame, item: str, text: str, label: str, per_class: int = SAMPLE) -> DataFrame:
    """Up to ``per_class`` labelled documents of each language and script, drawn by a hash of their ids."""
    body = df.where(F.col(item).isNotNull() & (F.length(text) > 0) & (F.length(text) <= SAMPLE_CHARS))
    latin = F.length(F.regexp_replace(text, r"[^A-Za-z]", "")) * 2 > F.length(F.regexp_replace(text, r"[^\p{L}]", ""))
    body = body.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text"), label_code(F.col(label)).alias("code"), latin.alias("latin"))
    # The script is only asked for where it makes a class.
    body = body.where(F.col("code").isNotNull()).withColumn("latin", F.col("code").isin(*TWO_SCRIPTS) & F.col("latin"))
    body = body.withColumn("class", F.concat_ws("-", "code", F.when(F.col("latin"), "latin").otherwise("own")))
    drawn = body.withColumn("draw", F.xxhash64("item", F.lit(3)))
    return top_n_per_group(drawn, ["class"], [("draw", "asc")], "item", per_class, keep=["code", "latin", "text"])


def fit_on(df: DataFrame, item: str, text: str, label: str, per_class: int = SAMPLE) -> Model:
    """The model of a table of labelled documents; at most ``per_class`` documents of each class reach the driver."""
    texts, labels = [], []
    codes = sorted(NAMES)
    classes = [(c, s) for c in codes for s in ((True, False) if c in TWO_SCRIPTS else (None,))]
    at = {x: i for i, x in enumerate(classes)}
    for r in training_sample(df, item, text, label, per_class).select("code", "latin", "item", "text").orderBy("code", "latin", "item").toLocalIterator():
        texts.append(r["text"])
        labels.append(at[(r["code"], bool(r["latin"]) if r["code"] in TWO_SCRIPTS else None)])
    return fit(words_in(texts), labels, tuple(c for c, _ in classes))


def _judged(texts: list[str | None], model: Model, change: float, shortest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(number of the text, seg_no, lang, words, confidence) of the texts with words, in their order."""
    found = words_in(texts)
    codes = np.array(model.codes)
    names = sorted(set(model.codes))
    same = (codes[:, None] == np.array(names)[None, :]).astype(np.float64)
    some = np.flatnonzero(found.counts)
    if not len(some):
        return some, some, np.empty(0, object), some, np.empty(0)
    counts = found.counts[some]
    scores = model.word_scores(found.distinct)[found.ids]

    def shares(total: np.ndarray, n: np.ndarray) -> np.ndarray:
        """(stretch, language): the damped posterior of each language."""
        total = total / np.sqrt(n)[:, None]
        share = np.exp(total - total.max(1, keepdims=True))
        return share @ same / share.sum(1, keepdims=True)

    main, mixed = mixed_texts(scores, counts, change)
    one = np.flatnonzero(~mixed)
    lang_of = np.array([names.index(c) for c in model.codes])
    sure = shares(_totals(scores, counts), counts)
    # (text, seg_no, language, words, confidence) of the texts of one language.
    parts = [np.column_stack([some[one], np.zeros(len(one)), lang_of[main[one]], counts[one], sure[one, lang_of[main[one]]]])]
    if mixed.any():
        which = np.flatnonzero(mixed)
        inside = scores[np.repeat(mixed, counts)]
        path = best_paths(inside, counts[which], change)
        rows: list[tuple] = []
        for text, end, n in zip(which, np.cumsum(counts[which]).tolist(), counts[which].tolist()):
            mine = inside[end - n : end]
            cut: list[list[int]] = []
            for a, b, c in _cut(path[end - n : end], mine, shortest):
                if cut and cut[-1][2] == lang_of[c]:
                    cut[-1][1] = b
                else:
                    cut.append([a, b, lang_of[c]])
            votes = np.zeros(len(names))
            for a, b, c in cut:
                votes[c] += b - a
            likely = [mine[:, codes == x].sum(0).max() for x in names] if (votes == votes.max()).sum() > 1 else votes
            top = max(range(len(names)), key=lambda i: (votes[i], likely[i]))
            rows.append((some[text], 0, top, n, sure[text, top]))
            if len({c for *_, c in cut}) > 1:
                total = np.add.reduceat(mine, [a for a, *_ in cut], axis=0)
                each = shares(total, np.array([b - a for a, b, _ in cut], np.float64))
                rows += [(some[text], i, c, b - a, each[i - 1, c]) for i, (a, b, c) in enumerate(cut, 1)]
        parts.append(np.array(rows))
    out = np.vstack(parts)
    out = out[np.lexsort((out[:, 1], out[:, 0]))]
    return out[:, 0].astype(np.int64), out[:, 1].astype(np.int32), np.array(names, object)[out[:, 2].astype(np.int64)], out[:, 3].astype(np.int32), out[:, 4]


def languages(df: DataFrame, item: str, text: str, model: Model, *, change: float = CHANGE, shortest: int = SHORTEST) -> DataFrame:
    """(item, seg_no, lang, words, confidence) of every document with words.

    seg_no 0 is the main language, the one of most words; 1, 2, … are the
    stretches of documents in more than one language.  ``confidence`` is the
    posterior of the language over the stretch, its evidence damped to the root
    of the number of words, as the words of a text aren't independent.  Null,
    empty and wordless texts give no rows.  Rows are judged one by one, also
    where ids repeat or are null; equal votes go by the likelihood.
    """
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast((model.logs, model.codes))
    kind = df.schema[item].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            begin = 0
            while begin < len(texts):
                end, held = begin, 0
                while end < len(texts) and (end == begin or held < HELD):
                    held += len(texts[end] or "")
                    end += 1
                rows, seg_no, lang, words, sure = _judged(texts[begin:end], model, change, shortest)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(rows + begin)), pa.array(seg_no, pa.int32()), pa.array(lang, pa.string()), pa.array(words, pa.int32()), pa.array(sure, pa.float64())],
                    names=["item", "seg_no", "lang", "words", "confidence"],
                )
                begin = end

    found = df.select(item, text).mapInArrow(run, f"item {kind}, seg_no int, lang string, words int, confidence double")
    return found.withColumnRenamed("item", item)


def mended_labels(df: DataFrame, item: str, text: str, label: str, *, per_class: int = SAMPLE) -> DataFrame:
    """``languages`` of the documents whose label is missing or wrong (seg_no 0), and of all mixed ones (seg_no from 1).

    A label in another spelling of the right language isn't wrong.  An empty
    table, or one without usable labels, is judged by a model that knows
    nothing.  Other columns are ignored.
    """
    model = fit_on(df, item, text, label, per_class)
    # The label travels with the id through the scan, so nothing is joined or shuffled.
    carried = df.select(F.struct(F.col(item).alias("id"), label_code(F.col(label)).alias("code")).alias("key"), F.col(text).alias("text"))
    found = languages(carried, "key", "text", model)
    keep = (F.col("seg_no") > 0) | ~F.col("key.code").eqNullSafe(F.col("lang"))
    return found.where(keep).select(F.col("key.id").alias(item), "seg_no", "lang", "words", "confidence")
