"""Toxicity scores: a learned lexicon, misspellings by automaton, and context windows.

``learn`` takes labelled texts and keeps the words and word beginnings that
stand in toxic texts far more often than chance allows. It is fitted on at
most ``FIT_ROWS`` labelled rows (those with the least hash of doc_id), so it
behaves alike at every size of the corpus; scoring covers every whole text. A
term must also stand in a share ``SUPPORT`` of the toxic texts: near copies of
one toxic text are no independent observations, and significance alone takes
their other words for terms.

Misspellings: the lexicon's words and word beginnings form a trie, which is
intersected with the Levenshtein automaton of each distinct word (the
automaton's state is the banded row of edit distances, which dies as soon as
all entries exceed the bound; a word beginning accepts when some beginning of
the word is near). A word enters the automaton if it holds a piece of a term
whole, about where the term has it: of ``edits`` + 1 pieces one is untouched
(a swap over a cut is looked for as such). One misspelling outside quotation
and reports reaches ``THRESHOLD``. Whether near words of a term count at all
is learned too: a term whose neighbours turn up in clean texts gets no fuzzy
weight.

Context: each hit looks at a window of words. Quotation marks around it and
reporting words lower its weight, address ("you", "you are") raises it.

score = 1 - exp(-evidence), where evidence is the sum of the hits' weights.

Defined cases: null and empty texts score 0; repeated rows score alike;
without any usable label the lexicon is empty and all scores are 0; further
columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadloom.llm.base import Lean, cut, slices

FIT_ROWS, SIGNIFICANCE, SUPPORT = 12_000, 12.0, 0.03
# Clean texts for each toxic one that a term may stand in: for full weight, and at all.
PURITY, WORST = 0.005, 0.12
EXACT, IMPURE, FUZZY, WINDOW, THRESHOLD = 0.7, 0.25, 0.4, 8, 0.3
SHORTEST, LONGEST, FUZZY_FROM, TWICE_FROM = 4, 10, 5, 12

WORD = re.compile(r"\w+(?:[@$*]\w+)*")
LEET = str.maketrans("013457@$*", "oieastas*")
HARD = re.compile(r"[\d@$*]")
# Words that report speech, and words of address.
REPORTING = {"said", "says", "quote", "quoted", "called", "word", "wrote", "term", "article", "zitat", "sagte", "dijo", "dit"}
ADDRESS = {"you", "your", "youre", "du", "tu", "eres", "es", "bist", "u"}
QUOTES = "\"“”«»„'‘’`"


def features(words: set[str]) -> set[str]:
    """A text's words, and its word beginnings marked with a star."""
    out = set(words)
    for w in words:
        for n in range(SHORTEST, min(len(w), LONGEST) + 1):
            out.add(w[:n] + "*")
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in slices(whole, "text", 16_000_000)):
        pos: Counter[str] = Counter()
        neg: Counter[str] = Counter()
        for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist(), strict=True):
            (pos if toxic else neg).update(features(set(WORD.findall(text.lower()))))
        terms = list(pos.keys() | neg.keys())
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array([pos[t] for t in terms], pa.int64()), pa.array([neg[t] for t in terms], pa.int64())], names=["term", "pos", "neg"])


def fit_sample(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """(toxic, text) of the labelled training rows; at most ``rows``, so the broadcast has a bound."""
    usable = labels.select(F.col("doc_id").alias("_id"), "toxic").filter("toxic is not null and _id is not null").filter(~held_out(F.col("_id")))
    some = usable.orderBy(F.xxhash64("_id"), "_id", "toxic").limit(rows)
    pairs = docs.select("doc_id", "text").join(F.broadcast(some), F.col("doc_id") == F.col("_id"))
    # Copies of one text are one observation.
    return pairs.filter("text is not null").select("toxic", F.col("text").cast("string").alias("text")).distinct()


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def learn(sample: DataFrame) -> dict:
    """The lexicon: {"words": {...}, "stems": {...}} with weights, and {"fuzzy": {word: weight}}."""
    # Written once: the corpus is not read again for each count.
    counts = cut(sample.select("toxic", F.coalesce("text", F.lit("")).alias("text")), "labelled")
    total = {int(r[0]): int(r[1]) for r in counts.groupBy("toxic").count().collect()}
    n_pos, n_neg = total.get(1, 0), total.get(0, 0)
    empty = {"words": {}, "stems": {}, "fuzzy": {}}
    if not n_pos or not n_neg:
        return empty
    surprise = -math.log(n_pos / (n_pos + n_neg))
    terms = counts.mapInArrow(Lean(_count), "term string, pos long, neg long").groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    good = terms.filter((F.col("pos") >= max(SIGNIFICANCE / surprise, SUPPORT * n_pos)) & (F.col("neg") <= F.col("pos") * WORST))
    # Bounded by the sample: a term stands in a share of SUPPORT of its toxic texts, so there are as many as 1 / SUPPORT of these texts have features at most.
    best = good.collect()
    found = choose({r[0]: (int(r[1]), int(r[2])) for r in best})
    found["fuzzy"] = {w: FUZZY for w, weight in found["words"].items() if len(w) >= FUZZY_FROM and weight == EXACT}
    found["fuzzy"] |= {w + "*": FUZZY for w, weight in found["stems"].items() if len(w) >= FUZZY_FROM and weight == EXACT}
    if found["fuzzy"]:
        heard = counts.filter("toxic = 0").mapInArrow(Lean(_near, found), "term string, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
        for term, n in heard:
            if n > max(1, 0.001 * n_neg):
                found["fuzzy"].pop(term, None)
    return found


def choose(terms: dict[str, tuple[int, int]]) -> dict:
    """Pure terms first, then impure ones that aren't mostly explained by them. Of a beginning and its extensions that hold nearly as many toxic texts, the longest; a whole word if it does."""
    words: dict[str, float] = {}
    stems: dict[str, float] = {}
    pure = lambda t: terms[t][1] <= terms[t][0] * PURITY
    for term in sorted((t for t in terms if t.endswith("*")), key=lambda t: (not pure(t), len(t), t)):
        stem, pos = term[:-1], terms[term][0]
        known = [terms[w][0] for w in words if w.startswith(stem)] + [terms[s + "*"][0] for s in stems if s.startswith(stem)]
        if any(stem.startswith(s) for s in stems) or max(known, default=0) >= (0.97 if pure(term) else 0.5) * pos:
            continue
        longer = [t for t in terms if t.startswith(stem) and terms[t][0] >= 0.97 * pos and pure(t) >= pure(term)]
        whole = max((t for t in longer if not t.endswith("*")), key=lambda t: terms[t][0], default=None)
        if whole:
            words[whole] = EXACT if pure(whole) else IMPURE
        else:
            longest = max((t for t in longer if t.endswith("*")), key=len)
            stems[longest[:-1]] = EXACT if pure(longest) else IMPURE
    for term in terms:
        if not term.endswith("*") and len(term) < SHORTEST:
            words[term] = EXACT if pure(term) else IMPURE
    return {"words": words, "stems": stems}


def trie(words: list[str]) -> dict:
    root: dict = {}
    for w in words:
        node = root
        stem = w.endswith("*")
        for c in w[:-1] if stem else w:
            node = node.setdefault(c, {})
        node["**" if stem else ""] = w
    return root


def within(word: str, root: dict, most: int) -> str | None:
    """The first lexicon word within ``most`` edits (a swap of neighbours counts as one), by walking the trie and the word's automaton together."""
    size = len(word)
    stack = [(root, None, "", list(range(size + 1)))]
    best: tuple[int, str] | None = None
    while stack:
        node, before, last, row = stack.pop()
        for end in ("", "**"):
            # A word beginning (its entry is "**") accepts wherever the word's beginning is near.
            if end in node:
                edits = row[size] if not end else min(row)
                if edits <= most and (best is None or (edits, node[end]) < best):
                    best = (edits, node[end])
        for c, child in node.items():
            if c in ("", "**"):
                continue
            new = [row[0] + 1]
            for j in range(1, size + 1):
                cost = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (word[j - 1] != c))
                if before is not None and j > 1 and c == word[j - 2] and last == word[j - 1]:
                    cost = min(cost, before[j - 2] + 1)
                new.append(cost)
            if min(new) <= most:
                stack.append((child, row, c, new))
    return best[1] if best else None


def edits_of(term: str) -> int:
    return 1 if len(term.rstrip("*")) < TWICE_FROM else 2


class Pieces:
    """Lets every word through that is within ``most`` edits of a term: of its most + 1 pieces one is untouched, shifted by at most ``most``; or a swap lies over a cut."""

    def __init__(self, terms: list[str], most: int):
        # For each start the pieces, with the lengths that a word can have.
        self.at: list[dict[str, set[int]]] = []
        for term in terms:
            w = term.rstrip("*")
            sizes = set(range(len(w) - most, 200 if term != w else len(w) + most + 1))
            cuts = [len(w) * k // (most + 1) for k in range(most + 2)]
            found = [(a, w[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)] + [(a - 1, w[a] + w[a - 1]) for a in cuts[1:-1]]
            for place, piece in found:
                for start in range(max(0, place - most), place + most + 1):
                    while len(self.at) <= start:
                        self.at.append({})
                    self.at[start].setdefault(piece, set()).update(sizes)
        self.lengths = [sorted({len(p) for p in t}) for t in self.at]

    def match(self, word: str) -> bool:
        size = min(len(word), 199)
        for start, (table, lengths) in enumerate(zip(self.at[:size], self.lengths, strict=False)):
            for n in lengths:
                if size in table.get(word[start : start + n], ()):
                    return True
        return False


class Matcher:
    """Looks words up: (term, weight, exact), remembered for a bounded number of distinct words."""

    MOST = 300_000

    def __init__(self, lexicon: dict):
        self.words, self.stems, self.fuzzy = lexicon["words"], lexicon["stems"], lexicon["fuzzy"]
        self.roots = {most: trie([w for w in self.fuzzy if edits_of(w) == most]) for most in (1, 2)}
        self.near = {most: Pieces([w for w in self.fuzzy if edits_of(w) == most], most) for most in (1, 2)}
        self.sizes = sorted({len(s) for s in self.stems})
        self.seen: set[str] = set()
        self.hits: dict[str, tuple[str, float, bool]] = {}

    def look(self, word: str) -> tuple[str, float, bool] | None:
        if word in self.words:
            return word, self.words[word], True
        for n in self.sizes:
            if word[:n] in self.stems and len(word) >= n:
                return word[:n], self.stems[word[:n]], True
        plain = word.translate(LEET) if HARD.search(word) else word
        if plain != word and plain in self.words:
            return plain, self.fuzzy.get(plain, FUZZY), False
        if plain != word:
            for n in self.sizes:
                if plain[:n] in self.stems and len(plain) >= n:
                    return plain[:n] + "*", self.fuzzy.get(plain[:n] + "*", FUZZY), False
        for most, near in self.near.items():
            if near.match(plain):
                term = within(plain, self.roots[most], most)
                if term:
                    return term, self.fuzzy[term], False
        return None

    def add(self, words: set[str]) -> list[str]:
        """The words of a text that are hits."""
        new = words - self.seen
        if new:
            if len(self.seen) + len(new) > self.MOST:
                self.seen, self.hits = set(), {}
                new = words
            for w in new:
                found = self.look(w)
                if found:
                    self.hits[w] = found
            self.seen |= new
        return [w for w in words if w in self.hits] if self.hits else []

    def score(self, text: str) -> float:
        lower = text.lower()
        hits = self.add(set(WORD.findall(lower)))
        if not hits:
            return 0.0
        spans = list(WORD.finditer(lower))
        words = [m.group() for m in spans]
        mine, evidence, heard = set(hits), 0.0, set()
        for i, w in enumerate(words):
            # A term that clean texts have too counts once a word; one such word is not enough.
            if w in mine and not (self.hits[w][1] == IMPURE and w in heard):
                heard.add(w)
                near = set(words[max(0, i - WINDOW) : i + WINDOW + 1])
                before, after = lower[max(0, spans[i].start() - 1) : spans[i].start()], lower[spans[i].end() : spans[i].end() + 1]
                weight = self.hits[w][1]
                if (before and before in QUOTES) or (after and after in QUOTES):
                    weight *= 0.5
                if near & REPORTING:
                    weight *= 0.7
                if near & ADDRESS:
                    weight *= 1.2
                evidence += weight
        return 1.0 - math.exp(-evidence)


def _near(lexicon: dict, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For clean texts: in how many each term's misspellings turn up."""
    m = Matcher(lexicon)
    for batch in (part for whole in batches for part in slices(whole, "text")):
        heard: Counter[str] = Counter()
        for text in batch.column("text").to_pylist():
            heard.update({m.hits[w][0] for w in m.add(set(WORD.findall(text.lower()))) if not m.hits[w][2]})
        if heard:
            yield pa.RecordBatch.from_arrays([pa.array(list(heard), pa.string()), pa.array(list(heard.values()), pa.int64())], names=["term", "n"])


def _score(lexicon: dict, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    m = Matcher(lexicon)
    for batch in (part for whole in batches for part in slices(whole, "text")):
        scores = [m.score(t) if t else 0.0 for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])


def score(docs: DataFrame, lexicon: dict) -> DataFrame:
    """doc_id, score for every row."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return base.mapInArrow(Lean(_score, lexicon), "doc_id long, score double")


def _keep(lexicon: dict, threshold: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    m = Matcher(lexicon)
    for batch in (part for whole in batches for part in slices(whole, "text")):
        keep = [(m.score(t) if t else 0.0) < threshold for t in batch.column("text").to_pylist()]
        yield batch.filter(pa.array(keep, pa.bool_()))


def reject(docs: DataFrame, lexicon: dict, threshold: float = THRESHOLD) -> DataFrame:
    """The rows, whole and with all columns, whose text scores under the threshold."""
    return docs.mapInArrow(Lean(_keep, lexicon, threshold), docs.schema)
