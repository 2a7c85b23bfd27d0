"""Secrets in texts: fixed patterns, and formats learned from what they match.

A first pass over the texts finds the pattern matches. The values of a bounded sample of them are labelled credentials: each
kind's values form a prefix tree whose states are merged while their futures are statistically compatible, which gives a
probabilistic automaton per kind. Another automaton is inferred in the same way from a bounded sample of all other tokens.
The second pass scores every other token by its likelihood under the automata; no token is left out by length or content.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorebook.llm.common import small_batches, whole

#: Labelled values per kind and other tokens that automata are fitted on, none of them longer than so many characters.
SAMPLE, OTHERS, LONGEST = 200, 1000, 256
#: Confidence of the merging test; folds in which labelled values are held out; share of these that may score too low.
ALPHA, FOLDS, QUANTILE = 0.05, 5, 0.02
#: One token in so many is taken to be a secret when its likelihoods as one and as an ordinary token are compared.
RARITY = 10_000
KINDS = ("assign", "access", "hex", "grammar")

# The patterns and least lengths of the base kinds.
_ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]{32,}")
LEAST = {"assign": 8, "access": 16, "hex": 32}

_TRIGGERS = (b"passw", b"secret", b"token", b"api")
#: Tokens of the shortest length a label can have; a name and its value are two, and a full stop at either end is not part.
_CANDIDATE = re.compile(rb"[A-Za-z0-9+/_-][A-Za-z0-9+/_.-]{%d,}[A-Za-z0-9+/_-]" % (min(LEAST.values()) - 2))
_REMEMBERED = 200_000
_SPAN = "struct<kind:int,start:long,end:long,value:string>"


def base_spans(text: bytes) -> list[tuple[int, int, int, bytes]]:
    """(kind, start, end, value) in bytes, leftmost and not overlapping within a kind."""
    found = []
    low = text.lower()
    if any(word in low for word in _TRIGGERS):
        found += [(0, m.start(), m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if b"AKIA" in text:
        found += [(1, m.start(), m.end(), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    found += [(2, m.start(), m.end(), m[0]) for m in _HEX.finditer(text)]
    return found


def candidates(text: bytes, base: list[tuple[int, int, int, bytes]]) -> Iterator[tuple[int, int, int, bytes]]:
    """Tokens that touch no base span; both are walked through once, in the order of the text."""
    taken = iter(sorted((s, e) for _, s, e, _ in base))
    ahead, reach = next(taken, None), 0
    for m in _CANDIDATE.finditer(text):
        while ahead and ahead[0] < m.end():
            reach, ahead = max(reach, ahead[1]), next(taken, None)
        if reach <= m.start():
            yield 3, m.start(), m.end(), m[0]


def _points(text: bytes, spans: list[tuple[int, int, int, bytes]]) -> list[dict]:
    """Spans with code points instead of bytes."""
    at = sorted({x for span in spans for x in span[1:3]})
    points, last, count = {}, 0, 0
    for x in at:
        count += len(text[last:x].decode("utf-8", "replace"))
        points[x], last = count, x
    ordered = sorted(spans, key=lambda s: (s[1], s[0]))
    return [{"kind": k, "start": points[s], "end": points[e], "value": v.decode()} for k, s, e, v in ordered]


def _examples(others: int) -> Callable:
    """(kind, value, hash): values of pattern matches, and of the other tokens those with the smallest hashes of each batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, least, bar = set(), {}, 1 << 63
            for value in batch.column(1):
                text = value.as_py()
                base = base_spans(text)
                found.update((k, v) for k, _, _, v in base if len(v) <= LONGEST)
                for _, _, _, token in candidates(text, base):
                    if len(token) <= LONGEST and (h := xxhash.xxh3_64_intdigest(token) >> 1) < bar:
                        least[token] = h
                        if len(least) >= 4 * others:
                            kept = sorted(least.items(), key=lambda x: x[1])[:others]
                            least, bar = dict(kept), kept[-1][1]
            rows = [(k, v.decode(), xxhash.xxh3_64_intdigest(v) >> 1) for k, v in found]
            rows += [(3, t.decode(), h) for t, h in sorted(least.items(), key=lambda x: x[1])[:others]]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int32(), pa.string(), pa.int64()))], names=["kind", "value", "hash"])

    return run


class Automaton:
    """Probabilistic automaton merged from the prefix tree of example strings.

    A core of accepted states grows from the root; of the states next to it, the one that most examples reach is decided
    first. It is merged into the accepted state it resembles most among those it does not differ from, or accepted
    itself. Two states differ if the frequency of ending or of a next symbol, there or at a common future, or the
    distribution of the number of symbols still to come is further apart than Hoeffding's and Kolmogorov's bounds allow.
    Merging adds up evidence, so that states few examples reach one by one are told apart together.
    """

    def __init__(self, examples: list[str], alpha: float = ALPHA) -> None:
        self.next: list[dict[str, int]] = [{}]
        self.seen: list[dict[str, int]] = [{}]
        self.ends, self.total = [0], [0]
        self.rest: list[Counter] = [Counter()]
        self._bound = math.sqrt(0.5 * math.log(2 / alpha))
        for text in examples:
            self._add(text)
        self._merge_all()
        used = Counter(c for text in examples for c in text)
        self._known = sum(used.values()) + len(used) + 1
        self._overall = {c: (n + 1) / self._known for c, n in used.items()}
        self._default = {s: max(sorted(self.seen[s]), key=lambda c, s=s: self.seen[s][c], default=None) for s in self.states}
        # Of each accepted state: costs and targets of its symbols, total visits, cost of ending, where other symbols lead.
        self._steps = {
            s: ({c: (math.log((n + self._overall[c]) / (self.total[s] + 1)), self.next[s][c]) for c, n in self.seen[s].items()},
                -math.log(self.total[s] + 1), math.log((self.ends[s] + 1 / self._known) / (self.total[s] + 1)),
                s if self._default[s] is None else self.next[s][self._default[s]])
            for s in self.states
        }
        self._rare = {c: math.log(p) for c, p in self._overall.items()}
        self._strange = -math.log(10 * self._known)

    def _add(self, text: str) -> None:
        state = 0
        for i, c in enumerate(text):
            self.total[state] += 1
            self.rest[state][len(text) - i] += 1
            if c not in self.next[state]:
                self.next[state][c] = len(self.next)
                self.next.append({})
                self.seen.append({})
                self.rest.append(Counter())
                self.ends.append(0)
                self.total.append(0)
            self.seen[state][c] = self.seen[state].get(c, 0) + 1
            state = self.next[state][c]
        self.total[state] += 1
        self.rest[state][0] += 1
        self.ends[state] += 1

    def _apart(self, a: int, b: int) -> float:
        """Greatest distance of the distributions of remaining lengths."""
        gap = most = 0.0
        for n in sorted(self.rest[a].keys() | self.rest[b].keys()):
            gap += self.rest[a][n] / self.total[a] - self.rest[b][n] / self.total[b]
            most = max(most, abs(gap))
        return most

    def _compatible(self, a: int, b: int) -> bool:
        waiting = [(a, b)]
        while waiting:
            a, b = waiting.pop()
            allowed = self._bound * (self.total[a] ** -0.5 + self.total[b] ** -0.5)
            if allowed < 1:
                shares = ((self.ends[a], self.ends[b]), *((self.seen[a].get(c, 0), self.seen[b].get(c, 0)) for c in self.seen[a].keys() | self.seen[b].keys()))
                if any(abs(x / self.total[a] - y / self.total[b]) > allowed for x, y in shares) or self._apart(a, b) > allowed:
                    return False
            waiting += [(self.next[a][c], self.next[b][c]) for c in self.next[a].keys() & self.next[b].keys() if self.next[a][c] != self.next[b][c]]
        return True

    def _fold(self, into: int, tree: int) -> None:
        """Add the subtree ``tree`` to state ``into`` and what follows it."""
        waiting = [(into, tree)]
        while waiting:
            a, b = waiting.pop()
            self.ends[a] += self.ends[b]
            self.total[a] += self.total[b]
            self.rest[a].update(self.rest[b])
            for c, n in self.seen[b].items():
                self.seen[a][c] = self.seen[a].get(c, 0) + n
                child = self.next[b][c]
                if c in self.next[a]:
                    waiting.append((self.next[a][c], child))
                else:
                    self.next[a][c] = child

    def _merge_all(self) -> None:
        self.states = [0]
        known = {0}
        while front := [(self.total[t], -t, s, c) for s in self.states for c, t in self.next[s].items() if t not in known]:
            _, minus, parent, c = max(front)
            state = -minus
            same = min((a for a in self.states if self._compatible(a, state)), key=lambda a: (self._apart(a, state), a), default=None)
            if same is None:
                self.states.append(state)
                known.add(state)
            else:
                self.next[parent][c] = same
                self._fold(same, state)

    def score(self, text: str, least: float = -math.inf) -> float:
        """Mean log-likelihood of the symbols and of ending after them; given up as minus infinity once below ``least``.

        A symbol that a state never had costs as if a share of one visit was spread as in all examples, and follows the
        state's most frequent symbol; a symbol that no example had costs a fixed amount.
        """
        state, total, bar = 0, 0.0, least * (len(text) + 1)
        for c in text:
            steps, rare, _, other = self._steps[state]
            step = steps.get(c)
            if step is None:
                total += rare + self._rare.get(c, self._strange)
                state = other
            else:
                total += step[0]
                state = step[1]
            if total < bar:
                return -math.inf
        return (total + self._steps[state][2]) / (len(text) + 1)


class Format:
    """An automaton with the threshold a token has to reach.

    Each of ``FOLDS`` parts of the examples is scored by an automaton inferred from the others; the threshold is the score that
    all but a share ``QUANTILE`` of the examples reach in this way.
    """

    def __init__(self, examples: list[str]) -> None:
        self.automaton = Automaton(examples)
        held_out = []
        for part in range(FOLDS):
            others = Automaton([x for i, x in enumerate(examples) if i % FOLDS != part])
            held_out += [others.score(x) for x in examples[part::FOLDS]]
        self.threshold = sorted(held_out)[int(QUANTILE * len(held_out))]

    def accepts(self, text: str, ordinary: Automaton | None) -> bool:
        """As likely as the examples, and likelier than as an ordinary token, of which there are ``RARITY`` for each secret."""
        own = self.automaton.score(text, self.threshold)
        return own >= self.threshold and (ordinary is None or (own - ordinary.score(text)) * (len(text) + 1) > math.log(RARITY))


def fit(values: dict[int, list[str]]) -> tuple[list[Format], Automaton | None]:
    """Formats of the labelled kinds, and the automaton of other tokens (kind 3); values in the order of their hashes."""
    formats = [Format(found) for kind, found in sorted(values.items()) if kind != 3 and len(found) >= FOLDS]
    return formats, Automaton(values[3]) if values.get(3) else None


def _judge(formats: list[Format], ordinary: Automaton | None) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())]))
        known: dict[bytes, bool] = {}

        def secret(token: bytes) -> bool:
            if (judged := known.get(token)) is None:
                text = token.decode()
                judged = any(x.accepts(text, ordinary) for x in formats)
                if len(token) <= LONGEST:
                    if len(known) >= _REMEMBERED:
                        known.clear()
                    known[token] = judged
            return judged

        for batch in batches:
            base, every = [], []
            for value in batch.column(1):
                text = value.as_py()
                found = base_spans(text)
                more = [x for x in candidates(text, found) if secret(x[3])] if formats else []
                base.append(_points(text, found) if found else [])
                every.append(_points(text, found + more) if more else base[-1])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, spans), pa.array(every, spans)], names=["doc_id", "base", "spans"])

    return run


def learn(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE, others: int = OTHERS) -> tuple[list[Format], Automaton | None]:
    """Formats fitted on ``docs``: of each kind the ``sample`` distinct values with the smallest hashes, and ``others`` other tokens.

    Values longer than ``LONGEST`` are no examples. A kind with fewer than ``FOLDS`` values has no format.
    """
    small_batches(docs)
    rows = docs.select(F.lit(0).alias("doc_id"), whole(text_col).cast("binary").alias("text"))
    found = rows.mapInArrow(_examples(others), "kind int, value string, hash long").distinct()
    nth = F.row_number().over(Window.partitionBy("kind").orderBy("hash", "value"))
    wanted = F.when(F.col("kind") == 3, others).otherwise(sample)
    values: dict[int, list[str]] = {}
    for row in found.withColumn("nth", nth).filter(F.col("nth") <= max(sample, others)).filter(F.col("nth") <= wanted).orderBy("kind", "nth").collect():
        values.setdefault(row["kind"], []).append(row["value"])
    return fit(values)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, others: int = OTHERS) -> DataFrame:
    """``doc_id``, ``base``, ``spans`` for every row: lists of (kind, start, end, value), by start, then kind.

    ``kind`` indexes ``KINDS``; ``start`` and ``end`` are code points of the whole text, end exclusive. ``base`` has the
    pattern matches, ``spans`` these and the tokens that a format accepts; base spans never go. Every token of at least
    the shortest length a label may have that touches no base span is scored whole, whatever its length. Null and
    empty texts have no spans; repeated rows and null ids are judged row by row. Other columns are dropped.
    """
    formats, ordinary = learn(docs, text_col, sample, others)
    rows = docs.select(F.col(id_col).alias("doc_id"), whole(text_col).cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_judge(formats, ordinary), f"doc_id {kind}, base array<{_SPAN}>, spans array<{_SPAN}>")


def joined(spans: str) -> F.Column:
    """A list of spans as ``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")
