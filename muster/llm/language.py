"""Language of texts by cross-parsing: the language whose texts cover a text in the fewest phrases wins."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster.llm.common import arrow_map

#: Bounds of the sample that the classifier is fitted on: texts per language and characters per language.
SAMPLE_TEXTS, SAMPLE_CHARS = 64, 48_000
#: Phrases end at every block of so many letters and gaps, so that long texts are parsed in parallel.
BLOCK = 256
UNKNOWN = "und"
#: Blocks parsed side by side.
_LANES = 4096
#: Places tried at once for a row of transitions.
_TRIED = 64
_LETTERS = re.compile(r"[^\W\d_]+")


def sample(docs: DataFrame, texts: int = SAMPLE_TEXTS, chars: int = SAMPLE_CHARS) -> list[tuple[str, str]]:
    """At most ``texts`` labelled texts of each language, ``chars`` characters in all: (lang, text), sorted by lang.

    Rows are drawn by a hash of their doc_id: the smallest of each of ``texts`` buckets. Buckets are reduced before
    texts are read, so only sampled texts reach the driver, each cut to its share of ``chars``.
    """
    labelled = docs.filter("lang is not null and doc_id is not null and text is not null")
    draw = F.xxhash64(F.lit("sample"), F.col("doc_id").cast("string"))
    drawn = labelled.select("lang", draw.alias("draw"))
    least = drawn.groupBy("lang", F.pmod("draw", F.lit(texts)).alias("bucket")).agg(F.min("draw").alias("draw"))
    wanted = [row.draw for row in least.select("draw").distinct().collect()]
    if not wanted:
        return []
    # Junk texts are short or repeat themselves; each text gives at most four times an even share.
    share = 4 * chars // texts
    rows = labelled.filter(draw.isin(wanted)).select("lang", draw.alias("draw"), F.substring("text", 1, share).alias("t"))
    out: dict[str, list[str]] = {}
    for row in sorted(rows.distinct().collect(), key=lambda r: (r.lang, r.draw, r.t)):
        out.setdefault(row.lang, []).append(row.t)
    return [(lang, "\n".join(found)[:chars]) for lang, found in sorted(out.items())]


class Automata:
    """A suffix automaton of each language's text; its size follows the text's, whatever the number of characters."""

    def __init__(self, fitted: tuple[tuple[str, str], ...]):
        self.langs = [lang for lang, _ in fitted]
        plain = [_plain(text) for _, text in fitted]
        seen = sorted(set("".join(plain)) - {" "})
        self.size = len(seen) + 3  # 0: padding, 1: a character never seen, 2: a gap
        self.codes = np.ones(0x110000, np.int32)
        self.codes[[ord(c) for c in seen]] = np.arange(3, self.size)
        self.codes[32] = 2
        self.tables = [_automaton(self.codes[_points(text)], self.size) for text in plain]
        self.scale = np.log2([max(2, len(text)) for text in plain])

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Phrases of every text in every language."""
        coded = [self.codes[_points(_plain(text))] for text in texts]
        blocks = np.array([-(-len(c) // BLOCK) for c in coded])
        owner = np.repeat(np.arange(len(texts)), blocks)
        flat = np.zeros((len(owner), BLOCK), np.int32)
        at = 0
        for c, n in zip(coded, blocks, strict=True):
            flat[at : at + n].reshape(-1)[: len(c)] = c
            at += n
        counts = np.zeros((len(texts), len(self.langs)))
        for low in range(0, len(owner), _LANES):
            steps = np.ascontiguousarray(flat[low : low + _LANES].T)
            for k, table in enumerate(self.tables):
                found = _parse(table, steps)
                np.add.at(counts[:, k], owner[low : low + _LANES], found)
        return counts


class Transitions:
    """Next states in one array: a state's row is shifted to where its few entries fall into free places, and each place names the
    state that it belongs to."""

    def __init__(self, follow: list[dict[int, int]], size: int):
        rows = [np.fromiter(steps, np.int64, len(steps)) for steps in follow]
        counts = np.array([len(row) for row in rows])
        total = int(counts.sum())
        used = np.zeros(2 * total + 4 * size, bool)
        self.base = np.zeros(len(follow), np.int32)
        place = size
        for state in np.argsort(-counts, kind="stable")[: int((counts > 1).sum())].tolist():
            # On from where the row before was placed; what is left free is for the states with one entry.
            codes, low = rows[state], place - int(rows[state].min())
            while True:
                if low + _TRIED + size >= len(used):
                    used = np.append(used, np.zeros(len(used), bool))
                fits = np.flatnonzero(~used[np.arange(low, low + _TRIED)[:, None] + codes].any(axis=1))
                if len(fits):
                    break
                low += _TRIED
            self.base[state] = low + fits[0]
            used[self.base[state] + codes] = True
            place = int(self.base[state] + codes.min()) + 1
        # States with one entry take what is free.
        single = np.flatnonzero(counts == 1)
        codes = np.array([rows[state][0] for state in single.tolist()], np.int64)
        free = np.flatnonzero(~used[size:])[: len(single)] + size
        if len(free) < len(single):
            free = np.append(free, len(used) + np.arange(len(single) - len(free)))
        self.base[single] = free - codes
        length = int(max(self.base.max(initial=0), 0)) + size + 1
        self.owner, self.next = np.full(length, -1, np.int32), np.zeros(length, np.int32)
        for state, steps in enumerate(follow):
            for code, target in steps.items():
                at = self.base[state] + code
                self.owner[at], self.next[at] = state, target
        self.start = np.zeros(size, np.int32)
        self.start[rows[0]] = [follow[0][code] for code in rows[0].tolist()]

    def __call__(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The state after ``code``, 0 where there is none."""
        at = self.base[state] + code
        return np.where(self.owner[at] == state, self.next[at], 0)


def _parse(table: Transitions, steps: np.ndarray) -> np.ndarray:
    """Phrases of each column of ``steps``: longest matches, one after another."""
    lanes = steps.shape[1]
    state, count = np.zeros(lanes, np.int32), np.zeros(lanes, np.int32)
    for code in steps:
        follow = table(state, code)
        # A phrase begins where nothing is matched yet or the match can't go on.
        begins = (state == 0) | (follow == 0)
        count += begins & (code > 0)
        state = np.where(follow == 0, table.start[code], follow)
    return count


def _plain(text: str) -> str:
    """Lower case, every run of other characters than letters one gap."""
    return " ".join(_LETTERS.findall(text.lower()))


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _automaton(codes: np.ndarray, size: int) -> Transitions:
    """Transitions of the suffix automaton of ``codes``; state 0 is the start."""
    follow: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for code in codes.tolist():
        new = len(follow)
        follow.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and code not in follow[at]:
            follow[at][code] = new
            at = link[at]
        if at >= 0:
            met = follow[at][code]
            if length[met] == length[at] + 1:
                link[new] = met
            else:
                copy = len(follow)
                follow.append(dict(follow[met]))
                length.append(length[at] + 1)
                link.append(link[met])
                while at >= 0 and follow[at].get(code) == met:
                    follow[at][code] = copy
                    at = link[at]
                link[met] = link[new] = copy
        last = new
    return Transitions(follow, size)


def predict(docs: DataFrame, fitted: list[tuple[str, str]], columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``docs`` (all, unless given) with ``lang_pred`` and ``score``, predicted from ``text`` alone.

    The entropy of a text under a language is its number of phrases times the logarithm of the language's text length;
    the least wins, the first by name among equals. The score is the best other language's share of the two,
    from one half (a tie) to 1; it is 1 if only one language was learned. Texts that are null or have no letter get
    'und' and 0, as do all texts when nothing was learned. Other columns pass through, whatever their names and values are,
    but for columns named as the two new ones, which are replaced.
    """
    # Built once: a few bytes for each of the sampled characters.
    model = docs.sparkSession.sparkContext.broadcast(Automata(tuple(fitted)))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs, scores = classify(batch.column(1).to_pylist(), model.value)
        columns = [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
        return pa.RecordBatch.from_arrays(columns, ["carried", "lang_pred", "score"])

    names = [c for c in columns or docs.columns if c not in ("lang_pred", "score")]
    whole = docs.select(F.struct(*[docs[f"`{c}`"] for c in names]).alias("carried"), F.col("text"))
    carried = whole.schema["carried"].dataType.simpleString()
    found = arrow_map(whole, run, f"carried {carried}, lang_pred string, score double")
    return found.select("carried.*", "lang_pred", "score")


def classify(texts: list[str | None], model: Automata) -> tuple[list[str], list[float]]:
    langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    known = [i for i, text in enumerate(texts) if text and any(map(str.isalpha, text))]
    if not model.langs or not known:
        return langs, scores
    low = 0
    while low < len(known):
        high, size = low, 0
        while high < len(known) and (high == low or size < 500_000):
            size += len(texts[known[high]])
            high += 1
        cost = model.phrases([texts[i] for i in known[low:high]]) * model.scale
        best = cost.argmin(axis=1)
        for row, i in enumerate(known[low:high]):
            langs[i] = model.langs[best[row]]
            rest = np.delete(cost[row], best[row])
            scores[i] = float(rest.min() / (rest.min() + cost[row, best[row]])) if len(rest) else 1.0
        low = high
    return langs, scores


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves ``part``. A null id is never held out and never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))
