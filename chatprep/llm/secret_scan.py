"""Secret scan with inferred grammars.

Patterns find the plain cases and label them: values of assignments, access keys and hex
keys.  For each kind a bounded sample of those credentials becomes a prefix tree whose
states are merged while their outgoing frequencies are statistically compatible (ALERGIA
with Hoeffding bounds); the result is a small probabilistic automaton of the format.
Every other long token of every text is a candidate and is scored by its log likelihood
per character under the best automaton, against a bigram model of ordinary long tokens.
A candidate that beats it by at least half of what the median labelled credential does is
a span of kind ``format``.  A candidate that does not, say a path or a URL, is taken apart
at its separators, the weak ones last, and each piece that does is a span.  Tokens and
pieces are scored from end to end, whatever their length.

One pass reads the texts and stores spans and candidates.  The automata are fitted on at
most ``SAMPLE`` whole labelled values of a kind, with ``CHARACTERS`` in all, chosen by hash; the bigrams count the character
pairs of all candidates, summed in the tasks, so only the counts reach the driver.

Null texts are empty.  Without labelled credentials there are no automata and no added
spans.  Repeated rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatprep.llm.common import read_table, stage
from chatprep.llm.spans import SPAN, Taken, listed, of_kind

KINDS = ["assign", "access", "hex", "format"]
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # maximal runs, as the shorter ones fail
TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
SAMPLE = 200
CHARACTERS = 200_000  # of the labelled values that one grammar is fitted on
PIECES = [TOKEN, *(re.compile(p) for p in (r"[^/=]{16,}", r"[^/=.]{16,}", r"[^/=._+-]{16,}"))]
ALPHA = 0.05
FLOOR = 1e-4
MARGIN = 0.5


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the pattern matches, per kind leftmost and without overlap."""
    found = []
    if ":" in text or "=" in text:
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return found


class Automaton:
    """A deterministic probabilistic automaton learnt from strings."""

    def __init__(self, strings: list[str], alpha: float = ALPHA):
        self.count, self.final, self.next, self.taken = [0], [0], [{}], [Counter()]
        for s in strings:
            state = 0
            self.count[0] += 1
            for c in s:
                self.taken[state][c] += 1
                if c not in self.next[state]:
                    self.next[state][c] = len(self.count)
                    self.count.append(0)
                    self.final.append(0)
                    self.next.append({})
                    self.taken.append(Counter())
                state = self.next[state][c]
                self.count[state] += 1
            self.final[state] += 1
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        self._merge_states()

    def _differ(self, a: int, n: int, b: int, m: int) -> bool:
        return abs(a / n - b / m) > self.bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))

    def _compatible(self, p: int, q: int) -> bool:
        todo = [(p, q)]
        while todo:
            p, q = todo.pop()
            n, m = self.count[p], self.count[q]
            if not n or not m:
                continue
            if self._differ(self.final[p], n, self.final[q], m):
                return False
            for c in self.taken[p].keys() | self.taken[q].keys():
                if self._differ(self.taken[p][c], n, self.taken[q][c], m):
                    return False
            todo += [(self.next[p][c], self.next[q][c]) for c in self.next[q] if c in self.next[p]]
        return True

    def _fold(self, p: int, q: int) -> None:
        """Add the tree below q to p."""
        todo = [(p, q)]
        while todo:
            p, q = todo.pop()
            self.count[p] += self.count[q]
            self.final[p] += self.final[q]
            self.taken[p] += self.taken[q]
            for c, child in self.next[q].items():
                if c in self.next[p]:
                    todo.append((self.next[p][c], child))
                else:
                    self.next[p][c] = child

    def _merge_states(self) -> None:
        red, blue = [0], [(0, c) for c in sorted(self.next[0])]
        while blue:
            parent, c = blue.pop(0)
            state = self.next[parent][c]
            if state in red:
                continue
            for r in red:
                if self._compatible(r, state):
                    self.next[parent][c] = r
                    self._fold(r, state)
                    break
            else:
                red.append(state)
            blue = [(s, k) for s in red for k in sorted(self.next[s]) if self.next[s][k] not in red]
        # Only these can be reached.
        number = {s: k for k, s in enumerate(red)}
        self.count, self.final, self.taken = ([x[s] for s in red] for x in (self.count, self.final, self.taken))
        self.next = [{c: number[k] for c, k in self.next[s].items()} for s in red]
        self.red = list(range(len(red)))
        self.usual = [self.next[s][max(sorted(self.next[s]), key=self.taken[s].__getitem__)] if self.next[s] else 0 for s in self.red]

    def per_character(self, s: str) -> float:
        """Mean log likelihood of the characters and of the end.

        A character that its state has not seen costs one floor and stands for the most
        frequent one there, so what follows is scored as well; after a state without any
        successor it is scored from the start.
        """
        state, total = 0, 0.0
        for c in s:
            n = self.count[state] or 1
            total += math.log(max(self.taken[state][c] / n, FLOOR))
            state = self.next[state].get(c, self.usual[state])
        total += math.log(max(self.final[state] / (self.count[state] or 1), FLOOR))
        return total / (len(s) + 1)


class Bigrams:
    """Ordinary long tokens: each character given the one before.

    ``seen`` has the counts of pairs, with ^ before the first character and $ after the last.
    A pair seen once counts as unseen: it may come from a credential among the tokens.
    """

    def __init__(self, seen: dict[tuple[str, str], int]):
        self.pairs = Counter({pair: n - 1 for pair, n in seen.items()})
        self.heads = Counter()
        for (a, _), n in self.pairs.items():
            self.heads[a] += n

    def per_character(self, s: str) -> float:
        return sum(math.log((self.pairs[a, b] + 0.1) / (self.heads[a] + 10)) for a, b in zip("^" + s, s + "$")) / (len(s) + 1)


class Formats:
    """Automata of all kinds, the ordinary tokens, and the margin a credential must reach."""

    def __init__(self, credentials: dict[str, list[str]], ordinary: dict[tuple[str, str], int]):
        self.automata = [Automaton(v) for _, v in sorted(credentials.items()) if v]
        self.ordinary = Bigrams(ordinary)
        reached = sorted(self.likelihood(s) for v in credentials.values() for s in v)
        self.least = max(MARGIN, reached[len(reached) // 2] / 2) if reached else math.inf

    def likelihood(self, token: str) -> float:
        """By how much the best format explains a token better than ordinary writing, per character."""
        if not self.automata:
            return -math.inf
        return max(a.per_character(token) for a in self.automata) - self.ordinary.per_character(token)

    def spans(self, token: str) -> list[tuple[int, int]]:
        """(start, end) of the token if it reaches the margin, or else of its pieces that do."""
        found, todo = [], [(0, len(token))]
        for pattern in PIECES:
            parts = [(part, m.span()) for part in todo for m in pattern.finditer(token, *part)]
            todo = []
            for whole, (start, end) in parts:
                seen = pattern is not TOKEN and whole == (start, end)
                if not seen and self.likelihood(token[start:end]) >= self.least:
                    found.append((start, end))
                else:
                    todo.append((start, end))
        return sorted(found)


SCAN = f"doc_id bigint, base array<{SPAN}>, labelled array<struct<kind:string,value:string>>, others array<struct<start:int,end:int,token:string>>"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("base", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))),
            ("labelled", pa.list_(pa.struct([("kind", pa.string()), ("value", pa.string())]))),
            ("others", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("token", pa.string())]))),
        ]
    )
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            base, labelled, others = [], [], []
            for text in batch.column(1).slice(at, 512):
                text = text.as_py() or ""
                spans = sorted(base_spans(text), key=lambda s: (s[1], KINDS.index(s[0])))
                taken = Taken(s[1:] for s in spans)
                values = [(k, ASSIGN.match(text, s)[2] if k == "assign" else text[s:e]) for k, s, e in spans]
                base.append([{"kind": k, "start": s, "end": e} for k, s, e in spans])
                labelled.append([{"kind": k, "value": v} for k, v in values])
                others.append(
                    [
                        {"start": m.start(), "end": m.end(), "token": m[0]}
                        for m in TOKEN.finditer(text)
                        if not taken.overlaps(*m.span())
                    ]
                )
            ids = batch.column(0).slice(at, 512)
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, f.type) for c, f in zip((base, labelled, others), list(schema)[1:]))], schema=schema)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists of candidates to the counts of their character pairs: the alphabet squared at most."""
    total = np.zeros(1 << 14, np.int64)
    for batch in batches:
        tokens = batch.column(0).flatten().field("token")
        for at in range(0, len(tokens), 512):
            text = "".join(f"^{t}$" for t in tokens.slice(at, 512).to_pylist())
            codes = np.frombuffer(text.encode("ascii"), np.uint8).astype(np.int64)
            total += np.bincount(codes[:-1] << 7 | codes[1:], minlength=1 << 14)
    total[ord("$") << 7 | ord("^")] = 0  # from one token to the next
    held = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["pair", "n"])


def character_pairs(scanned: DataFrame) -> dict[tuple[str, str], int]:
    """How often each pair of characters stands in the candidates of all texts.

    Occurrences, not distinct tokens: what is written often is ordinary.
    """
    counts = scanned.select("others").mapInArrow(_pairs, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    return {(chr(r["pair"] >> 7), chr(r["pair"] & 127)): r["n"] for r in counts.collect()}


def learn_formats(scanned: DataFrame, sample: int = SAMPLE) -> Formats:
    """Automata from a bounded sample of distinct credentials of each kind, bigrams of all candidates."""
    values = scanned.select(F.explode("labelled").alias("x")).select("x.kind", "x.value").distinct()
    values = values.filter(F.length("value") <= CHARACTERS)
    nth = F.row_number().over(Window.partitionBy("kind").orderBy(F.xxhash64("value"), "value"))
    chosen = values.withColumn("nth", nth).filter(F.col("nth") <= sample).select("kind", "nth", "value").collect()
    credentials, left = defaultdict(list), defaultdict(lambda: CHARACTERS)
    for kind, _, value in sorted(chosen):
        if len(value) <= left[kind]:
            left[kind] -= len(value)
            credentials[kind].append(value)
    return Formats({k: sorted(v) for k, v in credentials.items()}, character_pairs(scanned))


def _added(formats: Formats):
    @F.pandas_udf(f"array<{SPAN}>")
    def added(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for others in batches:
            yield pd.Series(
                [
                    [{"kind": "format", "start": o["start"] + s, "end": o["start"] + e} for o in row for s, e in formats.spans(o["token"])]
                    for row in others
                ]
            )

    return added


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, base (pattern spans) and spans (with those of inferred formats), in text order."""
    scanned = stage(docs.select("doc_id", "text").mapInArrow(_scan, SCAN), "secret-scan")
    added = _added(learn_formats(scanned))(F.col("others"))
    order = F.array(*[F.lit(k) for k in KINDS])

    def in_order(spans):
        ranked = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.array_position(order, s["kind"]).alias("k"), s["end"].alias("end"), s["kind"].alias("kind")))
        return F.transform(F.array_sort(ranked), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    return scanned.withColumn("added", added).select(
        "doc_id", "base", in_order(F.concat("base", "added")).alias("spans")
    )


def redact(text: str, spans: list[tuple[int, int]], mark: str = "[SECRET]") -> str:
    """The text with the spans replaced; overlapping spans give one mark."""
    out, at = [], 0
    for start, end in sorted(spans):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:]


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *[of_kind(F.col("base"), k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
