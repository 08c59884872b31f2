"""Toxicity by noisy-channel deobfuscation: restore disguised words, then score the restored text.

1. Language model: character trigrams of all plain words of all documents, counted in tasks
   and summed by Spark. Each has its own number. A model holds the ``TRIGRAMS`` most frequent ones, which bounds its
   size; text in some ten alphabets has fewer, and what lies behind them is read as unseen.
2. Channel: a disguised word is a lattice. A digit or sign stands for the letters it looks
   like, for itself as noise, or for nothing; a letter written several times for one or two;
   a blank or mark between letters for nothing or for a word's end. What is written, a letter
   twice or two words with a mark between, is the reading of cost 0. Viterbi finds the
   reading of highest channel and trigram probability. Words without doubled letters and
   such characters have one reading and need no search. In a word of letters only, the paths of one
   repeated letter meet again at the next letter, so each is decided where they meet.
3. Classifier: words and word beginnings that occur once, twice or three times in the restored text, learned from at most
   ``FIT_ROWS`` labelled texts (half of each class where there are enough; a bounded sample
   by hash; copies of a text with the same label count once). Every feature of five toxic
   texts is weighed against the clean ones in Spark; those of chance 0.5 and more come back. Features that nearly only occur in toxic rows are taken one by one, each for
   the toxic rows that no earlier one explains, so that copies of a text do not turn its
   other words into features. A text's score is 1 minus the chance that none of its words
   is a sign of toxicity.

Defined cases: null and empty texts score the base rate; without labelled rows of both
classes every score is 0; null labels are left out; several labels of one document count as
toxic if one is; repeated rows score alike. Columns named like an output are replaced.
"""

from __future__ import annotations

import heapq
import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import forget, kept, rare_collections, ship, sliced, strings_of, text_array, workspace

TRIGRAMS = 1 << 22
FIT_ROWS = 20_000
KEEP = 200_000
ASKED = 50_000  # probabilities a worker remembers
HELD = 100_000  # counts a task holds before it passes them on
SLICE = 2 << 20
PREFIXES = (3, 4, 5, 6, 7)
TIMES = (1, 2, 3)

# What digits and signs look like.
LOOKS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
MARKS = "*.-_~^'`,·/\\"
EDGE = "\"'()[]{}<>*.,;:!?#%&$@+=/|\\-_~^`·…«»„“”‚‘’¿¡§0123456789"
START, END = "^", "|"
ANY = "aeiou"  # what an asterisk among letters stands for
COST = {"same": 0.0, "looks": -0.7, "any": -2.0, "gone": -7.0, "mark": -0.4, "once": -0.3, "twice": -0.6, "end": -3.0,
        # against the written reading, which has a letter or a word's end more for the character model to charge
        "doubled": -3.0, "joined": -2.0}


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased words of all texts (empty ones stand for further blanks), and where each text's begin."""
    lists = pc.split_pattern(pc.replace_substring_regex(pc.utf8_lower(texts), r"[\x09-\x0d]", " "), " ")
    return lists.flatten(), lists.offsets.to_numpy().astype(np.int64)


def _trigrams(words: list[str], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigrams of words (framed by two starts and an end), three code points of 21 bits each, and their weights."""
    framed = [f"{START}{START}{w}{END}" for w in words]
    flat = np.frombuffer("".join(framed).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    lengths = np.fromiter(map(len, framed), dtype=np.int64, count=len(framed))
    ends = np.cumsum(lengths)
    keep = np.ones(len(flat), dtype=bool)
    keep[ends - 1] = keep[ends - 2] = False
    at = np.flatnonzero(keep)
    keys, which = np.unique(flat[at] << 42 | flat[at + 1] << 21 | flat[at + 2], return_inverse=True)
    return keys, np.bincount(which, np.repeat(weights, lengths - 2), len(keys))


class CharModel:
    """Character trigrams and their contexts with their counts, in order of their numbers."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.counts = keys[order], counts[order].astype(np.float64)
        first = np.flatnonzero(np.r_[True, self.keys[1:] >> 21 != self.keys[:-1] >> 21][: len(keys)])
        self.contexts = self.keys[first] >> 21
        self.sums = np.add.reduceat(self.counts, first) if len(first) else np.zeros(0)
        self.seen: dict[str, float] = {}
        self.once: dict[tuple[str, str, str, bool], bool] = {}

    @staticmethod
    def _at(keys: np.ndarray, values: np.ndarray, key: int) -> float:
        i = int(np.searchsorted(keys, key))
        return float(values[i]) if i < len(keys) and keys[i] == key else 0.0

    def log(self, a: str, b: str, c: str) -> float:
        found = self.seen.get(a + b + c)
        if found is None:
            pair = ord(a) << 21 | ord(b)
            n, of = self._at(self.keys, self.counts, pair << 21 | ord(c)), self._at(self.contexts, self.sums, pair)
            if len(self.seen) > ASKED:
                self.seen.clear()
            found = self.seen[a + b + c] = math.log((n + 0.05) / (of + 5.0))
        return found

    def single(self, before: str, c: str, after: str, long: bool) -> bool:
        """Whether a repeated letter between two others is read as one: both paths are in the same state after ``after``."""
        key = (before, c, after, long)
        found = self.once.get(key)
        if found is None:
            if len(self.once) > ASKED:
                self.once.clear()
            one, two = (COST["once"], COST["twice"]) if long else (COST["doubled"], COST["same"])
            one += self.log(before, c, after)
            two += self.log(before, c, c) + self.log(c, c, after)
            found = self.once[key] = one >= two
        return found


def learn_characters(docs: DataFrame) -> CharModel:
    """Trigrams of every plain word of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in sliced(batches, "text", SLICE):
            words, _ = split_words(text_array(batch.column("text")))
            counted = words.value_counts()
            distinct, times = strings_of(counted.field("values")), counted.field("counts").to_numpy()
            plain = [i for i, w in enumerate(distinct) if w.isalpha()]
            if plain:
                keys, n = _trigrams([distinct[i] for i in plain], times[plain].astype(np.float64))
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], ["trigram", "n"])

    ship(docs.sparkSession)
    counted = docs.select("text").mapInArrow(run, "trigram bigint, n double").groupBy("trigram").agg(F.sum("n").alias("n"))
    table = counted.orderBy(F.desc("n"), "trigram").limit(TRIGRAMS).toArrow()
    return CharModel(*(table[c].combine_chunks().to_numpy() for c in ("trigram", "n")))


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """Readings of each place of a disguised word: text and channel cost."""
    places = []
    for run in re.finditer(r"(.)\1*", token, re.S):
        c, n = run[1], len(run[0])
        if c.isalpha():
            several = [(c, COST["once"]), (c * 2, COST["twice"])] if n > 2 else [(c, COST["doubled"]), (c * 2, COST["same"])]
            places.append(several if n > 1 else [(c, COST["same"])])
        elif c == " ":
            places.append([("", COST["mark"]), (END, COST["end"])])
        elif c in LOOKS:
            read = [(x, COST["looks"]) for x in LOOKS[c]]
            places += [read + [("", COST["gone"])]] * min(n, 2) if n <= 2 else [read + [("", COST["mark"])]]
        elif c == "*" and n <= 2:
            places += [[(x, COST["any"]) for x in ANY] + [("", COST["gone"])]] * n
        else:
            places.append([("", COST["mark"])])
    return places


def viterbi(places: list[list[tuple[str, float]]], model: CharModel) -> list[str]:
    """Words of the most likely reading."""
    states = {(START, START): (0.0, None)}
    for readings in places:
        reached: dict = {}
        for (a, b), (score, path) in states.items():
            for text, cost in readings:
                x, y, s, p = a, b, score + cost, path
                for c in text:
                    if c == END and y == START:  # no word has begun
                        continue
                    s += model.log(x, y, c)
                    x, y, p = (START, START, (c, p)) if c == END else (y, c, (c, p))
                if (x, y) not in reached or s > reached[x, y][0]:
                    reached[x, y] = (s, p)
        states = reached
    _, path = max(((s + (0 if b == START else model.log(a, b, END)), p) for (a, b), (s, p) in states.items()), key=lambda z: z[0])
    letters = []
    while path is not None:
        letters.append(path[0])
        path = path[1]
    return [w for w in "".join(reversed(letters)).split(END) if w]


TWICE = re.compile(r"(.)\1", re.S)
SEVERAL = re.compile(r"(.)\1+", re.S)


def undouble(word: str, model: CharModel) -> str:
    """The most likely reading of a word of letters: each repeated letter once or twice."""
    parts, at = [], 0
    for run in SEVERAL.finditer(word):
        a, b = run.span()
        before, after = word[a - 1] if a else START, word[b] if b < len(word) else END
        parts += (word[at:a], run[1] if model.single(before, run[1], after, b - a > 2) else run[1] * 2)
        at = b
    return "".join(parts) + word[at:]
APART = re.compile(r"(?:[^\w@$!|+*(€£]|_)+")


def restore(token: str, model: CharModel) -> list[str]:
    """Plain words that a lower-cased token stands for."""
    if token.isalpha():
        return [undouble(token, model)] if TWICE.search(token) else [token]
    core = token.strip(EDGE)
    if core.isalpha() and core == token.rstrip(EDGE) and not TWICE.search(core) and not (token[-1] in LOOKS and token[-2:-1].isalpha()):
        return [core]
    # one sign before or after the letters may be a letter; more are decoration
    begin, end = token.find(core), token.find(core) + len(core)
    if not core:
        return []
    if begin and token[begin - 1] in LOOKS and (begin < 2 or token[begin - 2] != token[begin - 1]):
        begin -= 1
    if end < len(token) and token[end] in LOOKS and token[end + 1 : end + 2] != token[end]:
        end += 1
    core = token[begin:end]
    if core.isalpha():
        return [undouble(core, model)]
    single = re.fullmatch(rf"(?:[^\W_]|[{re.escape(''.join(LOOKS))}])(?:[{re.escape(MARKS)}]+(?:[^\W_]|[{re.escape(''.join(LOOKS))}])){{2,}}", core)
    if single or not APART.search(core):
        return viterbi(lattice(core), model)
    return viterbi(compound(core), model) if any(c.isalpha() for c in core) else []


def compound(core: str) -> list[list[tuple[str, float]]]:
    """Readings of parts with marks between: a mark stands for a word's end, as written, or for
    nothing; a sign alone for nothing, as written, or a letter; a number for a word's end."""
    places = []
    for part in filter(None, APART.split(core)):
        letters = any(c.isalpha() for c in part)
        if len(part) > 1 and not letters:
            places.append([(END, 0.0)])
            continue
        if places:
            places.append([(END, 0.0), ("", COST["joined"])])
        places += lattice(part) if letters else [[("", 0.0), *((x, COST["looks"]) for x in LOOKS.get(part, ""))]]
    return places


def spelled(words: pa.Array, starts: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Runs of three and more one-character words of one text, as written, and their texts."""
    one = pc.equal(pc.utf8_length(words), 1).to_numpy(zero_copy_only=False)
    edge = np.diff(np.r_[0, one.astype(np.int8), 0])
    begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = ends - begins >= 3
    runs, owners = [], []
    for a, b in zip(begins[long], ends[long]):
        first = int(np.searchsorted(starts, a, side="right")) - 1
        while a < b:  # a run ends with its text
            stop = min(b, int(starts[first + 1]))
            if stop - a >= 3:
                runs.append(" ".join(words.slice(a, stop - a).to_pylist()))
                owners.append(first)
            a, first = stop, first + 1
    return runs, np.array(owners, dtype=np.int64)


def features(word: str) -> list[str]:
    return [f"={word}", *(f"^{word[:n]}" for n in PREFIXES if len(word) > n)]


def known_features(known: set[str]):
    """Those of words' features that are ``known``; most words do not begin like any of them."""
    heads = {name[1:4] for name in known}
    return lambda words: tuple(f for w in words if w[:3] in heads for f in features(w) if f in known)


class Reader:
    """Restored words of texts; each distinct token is restored once and kept for a while."""

    def __init__(self, model: CharModel, value, keep: int = KEEP):
        self.model, self.value, self.keep, self.known = model, value, keep, {}

    def _of(self, tokens: list[str]) -> list:
        known = self.known
        if len(known) > self.keep:
            known.clear()
        found = list(map(known.get, tokens))
        for i, value in enumerate(found):
            if value is None:
                token = tokens[i]
                words = restore(token, self.model) if " " not in token else viterbi(lattice(token), self.model)
                found[i] = known[token] = self.value(words)
        return found

    def __call__(self, texts: pa.Array):
        """Values of the distinct tokens, each token's value number, where each text's tokens begin,
        and the values and texts of spelled-out runs."""
        words, starts = split_words(texts)
        coded = words.dictionary_encode()
        runs, owners = spelled(words, starts)
        return (
            self._of(strings_of(coded.dictionary)), coded.indices.to_numpy(zero_copy_only=False),
            starts, self._of(runs), owners,
        )


def _text_features(reader: Reader, texts: pa.Array) -> list[set[tuple[str, int]]]:
    """Features of each text with the numbers of times they are held at least."""
    values, which, starts, runs, owners = reader(texts)
    held = np.array([bool(v) for v in values], dtype=bool)
    found = []
    for i in range(len(texts)):
        own: Counter = Counter()
        here = which[starts[i] : starts[i + 1]]
        tokens, times = np.unique(here[held[here]], return_counts=True)
        for token, n in zip(tokens.tolist(), times.tolist()):
            for name in values[token]:
                own[name] += n
        found.append(own)
    for value, owner in zip(runs, owners):
        found[owner].update(value)
    return [{(name, k) for name, n in own.items() for k in TIMES if n >= k} for own in found]


@dataclass
class Model:
    """What scoring needs: the character model, chance of toxicity by feature and times, base rate."""

    characters: CharModel
    chance: dict[tuple[str, int], float]
    base: float
    name: str = field(default_factory=lambda: uuid.uuid4().hex)


def learn(docs: DataFrame, labels: DataFrame, characters: CharModel, rows: int = FIT_ROWS) -> Model:
    """Fit on ``labels`` (doc_id, toxic) joined with ``docs``, at most ``rows`` distinct (text, toxic) of them."""
    spark = docs.sparkSession
    labels = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("digest", F.md5("text"))
    # copies count once, in the sizes of the classes and in the sample: one document for each text
    pairs = texts.select("doc_id", "digest").join(labels, "doc_id").groupBy("digest", "toxic").agg(F.min("doc_id").alias("doc_id"))
    pairs = workspace(spark).stage(pairs, "toxicity-labelled")
    sizes = {r["toxic"]: r["count"] for r in pairs.groupBy("toxic").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        return Model(characters, {}, 0.0)
    draw = lambda k, n: pairs.filter(F.col("toxic") == k).orderBy("digest").limit(n)
    sample = F.broadcast(draw(1, rows // 2).union(draw(0, rows // 2)))  # at most ``rows`` rows
    drawn = texts.join(sample, ["doc_id", "digest"]).select("text", "toxic").distinct()
    sent = spark.sparkContext.broadcast(characters)
    ship(spark)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        reader = Reader(sent.value, lambda words: [f for w in words for f in features(w)], KEEP // 8)
        found: tuple[Counter, Counter] = (Counter(), Counter())

        def flush() -> Iterator[pa.RecordBatch]:
            for toxic, own in enumerate(found):
                names = list(own)
                columns = [
                    pa.array([n for n, _ in names], pa.string()), pa.array([k for _, k in names], pa.int32()),
                    pa.array([toxic] * len(names), pa.int32()), pa.array(list(own.values()), pa.int64()),
                ]
                own.clear()
                yield pa.RecordBatch.from_arrays(columns, ["feature", "times", "toxic", "n"])

        for batch in sliced(batches, "text", SLICE):
            for toxic, own in zip(batch.column("toxic").to_pylist(), _text_features(reader, text_array(batch.column("text")))):
                found[toxic].update(own)
                if len(found[0]) + len(found[1]) > HELD:
                    yield from flush()
        yield from flush()

    # both classes' texts that hold each feature, and its chance, in Spark; what comes back has a chance of 0.5 at least
    least = 5
    n_toxic, n_clean = min(sizes[1], rows // 2), min(sizes[0], rows // 2)
    odds = sizes[1] / n_toxic / (sizes[0] / n_clean)  # undo the even draw of classes
    drawn = drawn.withColumn("toxic", F.col("toxic").cast("int"))
    spread = drawn.repartition(spark.sparkContext.defaultParallelism)
    of = lambda k: F.sum(F.when(F.col("toxic") == k, F.col("n")).otherwise(0)).alias(f"n{k}")
    made = spread.mapInArrow(count, "feature string, times int, toxic int, n bigint").groupBy("feature", "times").agg(of(1), of(0))
    made = made.filter(F.col("n1") >= least).select("feature", "times", _chance(F.col("n1"), F.col("n0"), odds).alias("chance"))
    table = made.filter("chance >= 0.5").toArrow()
    names = list(zip(strings_of(table["feature"].combine_chunks()), table["times"].to_pylist()))
    chance = table["chance"].to_pylist()
    wanted = spark.sparkContext.broadcast({name: i for i, name in enumerate(names)})

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = wanted.value
        reader = Reader(sent.value, known_features({name for name, _ in number}), KEEP // 8)
        for batch in sliced(batches, "text", SLICE):
            found = [[number[f] for f in own if f in number] for own in _text_features(reader, text_array(batch.column("text")))]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32()))], ["held"])

    held = drawn.filter("toxic = 1").select("text").mapInArrow(hold, "held array<int>").toArrow()["held"].combine_chunks()  # at most rows / 2
    numbers = held.flatten().to_numpy(zero_copy_only=False)
    holders = np.repeat(np.arange(len(held)), np.diff(held.offsets.to_numpy()))[np.argsort(numbers, kind="stable")]
    ends = np.cumsum(np.bincount(numbers, minlength=len(names)))
    rows_of = np.split(holders, ends[:-1]) if names else []
    # take the feature that explains most of the toxic rows not yet explained; what others
    # explain only falls, so the first of the heap that is up to date is the best
    order = sorted(range(len(names)), key=lambda i: (names[i][0][0] == "=", len(names[i][0]), names[i]), reverse=True)
    heap = [(-len(rows_of[i]) * chance[i], place, len(rows_of[i])) for place, i in enumerate(order)]
    heapq.heapify(heap)
    chosen, explained = {}, np.zeros(len(held), dtype=bool)
    while heap:
        _, place, had = heap[0]
        i = order[place]
        left = int(np.count_nonzero(~explained[rows_of[i]]))
        if left < least:
            heapq.heappop(heap)
        elif left < had:
            heapq.heapreplace(heap, (-left * chance[i], place, left))
        else:
            heapq.heappop(heap)
            chosen[names[i]] = chance[i]
            explained[rows_of[i]] = True
    missed = (n_toxic - int(explained.sum()) + 0.5) * odds
    return Model(characters, chosen, missed / (missed + n_clean + 1.0))


def _chance(toxic: Column, clean: Column, odds: float) -> Column:
    """Chance that a text with a feature is toxic, from the lower end of the Wilson interval (one deviation)."""
    n = toxic + clean
    share = toxic / n
    low = (share + 0.5 / n - F.sqrt(share * (1 - share) / n + 0.25 / (n * n))) / (1 + 1 / n)
    return odds * low / (odds * low + 1 - low)


def add_score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """All columns of ``docs`` and the text's score."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop(name)
    order = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rare_collections()
        learned = sent.value
        reader = kept(("toxicity", learned.name), lambda: Reader(learned.characters, known_features({f for f, _ in learned.chance})))
        for batch in sliced(batches, "text", SLICE):
            clean = np.full(batch.num_rows, 1.0 - learned.base)
            for i, own in enumerate(_text_features(reader, text_array(batch.column("text")))):
                best: dict[str, float] = {}
                for feature, times in own:
                    best[feature] = max(best.get(feature, 0.0), learned.chance.get((feature, times), 0.0))
                for p in best.values():
                    clean[i] *= 1.0 - p
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.clip(1.0 - clean, 0.0, 1.0))], [*order, name])

    ship(docs.sparkSession)
    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def held_out(doc_id, modulus: int = 5, rest: int = 0):
    """Rows no label is learned from: CRC-32 of the id as text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % modulus == rest


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """Character model of all documents, classifier from the labels that are not held out."""
    return learn(docs, labels.filter(~held_out(F.col("doc_id"))), learn_characters(docs), rows)
