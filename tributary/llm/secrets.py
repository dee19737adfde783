"""Secret scan: fixed patterns, and formats learned from the credentials these patterns label.

Learning infers a grammar: the credentials of each kind make a prefix tree whose states carry counts, and states that
are statistically compatible are merged into a probabilistic automaton. Random credentials share no prefixes, so the
states of one depth are pooled first unless what follows them differs. Then states are merged that enough words
have passed on both sides, if no count on any path behind them differs by more than chance allows. So a fixed
prefix, the alphabet of each place and a fixed length survive as a chain of states, and only formats of free length get loops.
A format also knows the lengths of its words and which classes of characters nearly all of them hold. Ordinary tokens
make automata of their own, one for long and one for short tokens. A token counts as a secret if some
credential format admits it and explains it better than ordinary text of its length does, by a margin set on the labelled
tokens. Numbers, dates and words thus stay unless credentials of their kind and length have been seen.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import Memo, Stage, over_rows, texts, with_rows

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# A run of hex digits that is long enough; shorter runs fail and are passed over.
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
ASSIGN_VALUE, ACCESS_LENGTH = 8, 16
TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]{%d,}" % ASSIGN_VALUE)
#: Tokens from this length on are long.
LONG = 16
#: Kinds in the order they are listed; `format` holds what only the automata find.
KINDS = ("assign", "access", "hex", "format")
ORDINARY, ORDINARY_SHORT = "ordinary", "ordinary short"

#: Credentials of each kind, and long and short ordinary tokens each, that the automata are learned from, at most: those with
#: the smallest hashes.
SAMPLE, ORDINARY_SAMPLE = 400, 4_000
#: Longer tokens are scored like others, but formats are not learned from them.
LONGEST_LEARNED = 4_096
#: So many words must have passed two states before these count as alike or as different.
EVIDENCE = 20
#: Symbols that are looked at to tell whether words go on differently.
LOOK_AHEAD = 4
#: A class of characters that such a share of a format's words hold is asked of every word.
HELD_BY = 0.95


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, credential) of what the patterns match, leftmost and non-overlapping per kind."""
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LENGTH]
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str, base: list[tuple[int, int, int, str]]) -> Iterator[tuple[int, int, str]]:
    """What of a token lies outside the base spans, if long enough for a credential: (start, end, part)."""
    merged: list[list[int]] = []
    for start, _, end, _ in base:
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    first = 0
    for m in TOKEN.finditer(text):
        at = m.start()
        while first < len(merged) and merged[first][1] <= at:
            first += 1
        parts, i = [], first
        while i < len(merged) and merged[i][0] < m.end():
            parts.append((at, merged[i][0]))
            at = max(at, merged[i][1])
            i += 1
        for start, end in [*parts, (at, m.end())]:
            if end - start >= ASSIGN_VALUE:
                yield start, end, text[start:end]


@dataclass
class Automaton:
    """A probabilistic automaton: counts of visits, ends and symbols, and the next state by symbol."""

    visits: list[int] = field(default_factory=lambda: [0])
    ends: list[int] = field(default_factory=lambda: [0])
    edges: list[dict[str, int]] = field(default_factory=lambda: [{}])
    counts: list[dict[str, int]] = field(default_factory=lambda: [{}])

    def logp(self, word: str) -> float:
        """Mean log likelihood per symbol, the end included; minus infinity if a step was never seen.

        Where several symbols have been seen, so that chance may have left some out, the others of the format have
        a small share, and lead where the most frequent one does.
        """
        state, total = 0, 0.0
        for symbol in word:
            counts = self.counts[state]
            if symbol not in counts and (len(counts) < 2 or symbol not in self._alphabet()):
                return -math.inf
            total += math.log((counts.get(symbol, 0) or 0.5) / self.visits[state])
            state = self.edges[state][symbol if symbol in counts else max(counts, key=lambda c: (counts[c], c))]
        return (total + math.log((self.ends[state] + 0.5) / (self.visits[state] + 1))) / (len(word) + 1)

    def _alphabet(self) -> frozenset[str]:
        if "_symbols" not in self.__dict__:
            self.__dict__["_symbols"] = frozenset().union(*self.counts)
        return self.__dict__["_symbols"]

    def smooth_logp(self, word: str, alphabet: int = 68, share: float = 0.5) -> float:
        """As logp, but a symbol unseen in a state has a small share there and leads back to the root."""
        state, total = 0, 0.0
        for symbol in word:
            total += math.log((self.counts[state].get(symbol, 0) + share) / (self.visits[state] + share * (alphabet + 1)))
            state = self.edges[state].get(symbol, 0)
        return (total + math.log((self.ends[state] + share) / (self.visits[state] + share * (alphabet + 1)))) / (len(word) + 1)


def _differ(k1: int, n1: int, k2: int, n2: int, bound: float) -> bool:
    return abs(k1 / n1 - k2 / n2) > bound * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))


def _classes(symbols: Iterable[str]) -> list[int]:
    """How many digits, lower-case letters, upper-case letters and other symbols."""
    out = [0, 0, 0, 0]
    for c in symbols:
        out[0 if "0" <= c <= "9" else 1 if "a" <= c <= "z" else 2 if "A" <= c <= "Z" else 3] += 1
    return out


def _apart(n: np.ndarray, mine: np.ndarray, bound: float) -> np.ndarray:
    """For each symbol, whether the words that go on with it differ from the others: `mine` counts, by symbol, the
    words that have each of some properties, and `n` the words."""
    rest, m = mine.sum(axis=0) - mine, n.sum() - n
    with np.errstate(divide="ignore", invalid="ignore"):
        apart = np.abs(mine / n[:, None] - rest / m[:, None]) > (bound * (1 / np.sqrt(n) + 1 / np.sqrt(m)))[:, None]
    return apart.any(axis=1) & (n >= EVIDENCE) & (m >= EVIDENCE)


def _pooled(words: list[str], bound: float) -> Automaton:
    """The prefix tree with the states of one depth pooled, unless enough words tell that they go on differently: in
    their length, or in the symbols or classes of one of the next places.

    A state that few words reach is its own successor, so rare long words make no chain of states of their own.
    """
    tree = Automaton()
    visits, ends, edges, counts = tree.visits, tree.ends, tree.edges, tree.counts
    symbols = sorted(set("".join(words)))
    k = len(symbols)
    place = {c: i for i, c in enumerate(symbols)}
    lengths = np.array([len(w) for w in words], np.int64)
    # Behind its end a word goes on with a symbol of its own.
    text = np.full((len(words), int(lengths.max(initial=0)) + LOOK_AHEAD + 1), k, np.int16)
    for i, word in enumerate(words):
        text[i, :len(word)] = [place[c] for c in word]
    class_of = np.array([_classes(c) for c in symbols] + [[0] * 4], np.int64).reshape(k + 1, 4)
    _, rank = np.unique(lengths, return_inverse=True)

    def by_symbol(now: np.ndarray, then: np.ndarray, kinds: int) -> np.ndarray:
        return np.bincount(now.astype(np.int64) * kinds + then, minlength=(k + 1) * kinds).reshape(k + 1, kinds)[:k]

    todo = [(0, 0, np.arange(len(words)))]
    while todo:
        state, depth, group = todo.pop()
        if len(group) < EVIDENCE:
            for i in group.tolist():
                for symbol in words[i][depth:]:
                    counts[state][symbol] = counts[state].get(symbol, 0) + 1
                    edges[state][symbol] = state
                visits[state] += len(words[i]) - depth + 1
                ends[state] += 1
            continue
        now = text[group, depth]
        n = np.bincount(now, minlength=k + 1)[:k]
        visits[state], ends[state] = len(group), len(group) - int(n.sum())
        counts[state] = {symbols[c]: int(n[c]) for c in np.flatnonzero(n).tolist()}
        properties = [by_symbol(now, rank[group], int(rank.max()) + 1).cumsum(axis=1)]
        for at in range(depth + 1, depth + 1 + LOOK_AHEAD):
            following = by_symbol(now, text[group, at], k + 1)
            properties += [following, following @ class_of]
        own = _apart(n, np.concatenate(properties, axis=1), bound)
        for c in np.flatnonzero(own).tolist():
            todo.append((_new_state(tree, state, symbols[c]), depth + 1, group[now == c]))
        pool = np.flatnonzero((n > 0) & ~own)
        if len(pool):
            todo.append((_new_state(tree, state, *[symbols[c] for c in pool.tolist()]), depth + 1, group[np.isin(now, pool)]))
    return tree


def _new_state(tree: Automaton, parent: int, *symbols: str) -> int:
    state = len(tree.visits)
    tree.visits.append(0)
    tree.ends.append(0)
    tree.edges.append({})
    tree.counts.append({})
    for symbol in symbols:
        tree.edges[parent][symbol] = state
    return state


def infer(words: Iterable[str], alpha: float = 0.01) -> Automaton:
    """Merge the states of the words' pooled prefix tree that are alike by Hoeffding's bound at level alpha.

    States are taken from the root outwards. One that is like a kept state is folded into it, else it is
    kept itself; both must have been passed by enough words to tell. The order of words does not matter. No words
    give an automaton that accepts nothing.
    """
    bound = math.sqrt(0.5 * math.log(2 / alpha))
    tree = _pooled(sorted(words), bound)
    visits, ends, edges, counts = tree.visits, tree.ends, tree.edges, tree.counts

    def met(a: int, b: int) -> set[tuple[int, int]] | None:
        """The pairs of states behind two; None if one behind `b` would have to go into several."""
        pairs = {(edges[a][c], edges[b][c]) for c in edges[b] if c in edges[a]}
        return pairs if len({y for _, y in pairs}) == len(pairs) else None

    # What is compared of a state: how many words end there, and go on with each symbol and each class of symbols.
    symbols = sorted(set().union(*counts))
    at = {c: i for i, c in enumerate(symbols)}
    follow = np.zeros((len(visits), len(symbols)))
    for state, held in enumerate(counts):
        for c, n in held.items():
            follow[state, at[c]] = n
    class_of = np.array([_classes(c) for c in symbols], float).reshape(len(symbols), 4)
    seen = np.concatenate([np.array(ends, float)[:, None], follow, follow @ class_of], axis=1)
    passed = np.array(visits, float)

    def compatible(some: list[int], b: int) -> np.ndarray:
        """For each of some states, whether its counts differ from those of `b` by no more than chance allows."""
        n, m = np.maximum(passed[some], 1), max(passed[b], 1)
        limit = bound * (1 / np.sqrt(n) + 1 / math.sqrt(m))
        return (np.abs(seen[some] / n[:, None] - seen[b] / m) <= limit[:, None]).all(axis=1)

    def alike(a: int, b: int) -> bool:
        todo, done = [(a, b)], set()
        while todo:
            a, b = pair = todo.pop()
            if pair in done or a == b:
                continue
            done.add(pair)
            behind = met(a, b)
            # Too few words behind either state tell nothing about it.
            if behind is None or min(passed[a], passed[b]) >= EVIDENCE and not compatible([a], b)[0]:
                return False
            todo += behind
        return True

    def fold(a: int, b: int) -> None:
        todo, done = [(a, b)], set()
        while todo:
            a, b = todo.pop()
            if b in done or a == b:
                continue
            done.add(b)
            todo += met(a, b) or ()
            passed[a] += passed[b]
            seen[a] += seen[b]
            visits[a] += visits[b]
            ends[a] += ends[b]
            for symbol, n in counts[b].items():
                counts[a][symbol] = counts[a].get(symbol, 0) + n
                if symbol not in edges[a]:
                    edges[a][symbol] = a if edges[b][symbol] == b else edges[b][symbol]

    # What lies behind a state that is not kept yet is a tree with loops at its leaves, so folding it ends.
    kept, is_kept = [0], {0}
    while True:
        fringe = {edges[k][c] for k in kept for c in edges[k]} - is_kept
        if not fringe:
            break
        state = min(fringe, key=lambda s: (-visits[s], s))
        twin = None
        if visits[state] >= EVIDENCE:
            near = compatible(kept, state) & (passed[kept] >= EVIDENCE)
            twin = next((k for k, close in zip(kept, near.tolist()) if close and alike(k, state)), None)
        if twin is None:
            kept.append(state)
            is_kept.add(state)
        else:
            fold(twin, state)
            for k in kept:
                if state in edges[k].values():
                    edges[k] = {c: twin if t == state else t for c, t in edges[k].items()}
    place = {k: i for i, k in enumerate(kept)}
    return Automaton(
        [visits[k] for k in kept], [ends[k] for k in kept],
        [{s: place[t] for s, t in edges[k].items()} for k in kept], [counts[k] for k in kept],
    )


@dataclass
class Format:
    """The automaton of a credential kind, the range of its words' lengths, and the classes nearly all of them hold."""

    automaton: Automaton
    shortest: int
    longest: int
    holds: list[bool]

    @classmethod
    def of(cls, words: list[str]) -> Format:
        lengths = [len(w) for w in words]
        held = [_classes(w) for w in words]
        return cls(infer(words), min(lengths), max(lengths), [sum(h[i] > 0 for h in held) >= HELD_BY * len(words) for i in range(4)])

    def logp(self, token: str) -> float:
        if not self.shortest <= len(token) <= self.longest:
            return -math.inf
        if any(must and not n for must, n in zip(self.holds, _classes(token))):
            return -math.inf
        return self.automaton.logp(token)


@dataclass
class Formats:
    """Automata of the credential kinds and of ordinary tokens, and the margin a secret must have: of long tokens,
    then of short ones."""

    kinds: list[Format]
    ordinary: Automaton
    margin: float
    ordinary_short: Automaton
    margin_short: float

    def score(self, token: str) -> float:
        """How much better, in nats a symbol, the best credential format explains a token than ordinary text."""
        best = max((a.logp(token) for a in self.kinds), default=-math.inf)
        plain = self.ordinary if len(token) >= LONG else self.ordinary_short
        return best - plain.smooth_logp(token) if best > -math.inf else best

    def is_secret(self, token: str) -> bool:
        return self.score(token) > (self.margin if len(token) >= LONG else self.margin_short)


def _quantile(values: list[float], q: float) -> float:
    return sorted(values)[int(q * (len(values) - 1))]


def learn(labelled: dict[str, list[str]], least: float = 0.5) -> Formats:
    """Formats from tokens by kind. The margin is halfway from the 97th percentile of ordinary tokens, of which
    a few may be credentials nobody has labelled, to the 5th percentile of the hardest credential kind; at
    least `least` nats a symbol, and never below the former. Short tokens have a margin of their own, set on short
    credentials and, as most of them are words, on the 99th percentile. Without credentials nothing is a secret."""
    plain, short = labelled.get(ORDINARY, []), labelled.get(ORDINARY_SHORT, [])
    given = {kind: words for kind, words in sorted(labelled.items()) if kind not in (ORDINARY, ORDINARY_SHORT) and words}
    kinds = [Format.of(words) for words in given.values()]
    # What a format admits may be a credential nobody has labelled, so ordinary text is learned from the rest.
    others = [[w for w in words if all(k.logp(w) == -math.inf for k in kinds)] for words in (plain, short)]
    formats = Formats(kinds, infer(others[0]), least, infer(others[1]), least)

    def margin(credentials: list[list[str]], others: list[str], q: float) -> float:
        low = _quantile([formats.score(w) for w in others], q) if others else least
        high = min((_quantile([formats.score(w) for w in words], 0.05) for words in credentials), default=low)
        return max(least, low, (low + high) / 2 if low > -math.inf else least)

    if given:
        formats.margin = margin(list(given.values()), plain, 0.97)
        few = [[w for w in words if len(w) < LONG] for words in given.values()]
        formats.margin_short = margin([words for words in few if words], short, 0.99)
    return formats


def learn_from(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE, ordinary: int = ORDINARY_SAMPLE) -> Formats:
    """Learn the formats of a table: credentials as the patterns label them, and ordinary tokens beside them.

    Every text is read, whole. The `sample` distinct credentials of each kind and the `ordinary` other tokens, long and
    short each, with the smallest hashes reach the driver, so what is learned depends neither on the order of rows nor on
    copies.
    """

    most = {**{kind: sample for kind in KINDS[:3]}, ORDINARY: ordinary, ORDINARY_SHORT: ordinary}

    def run(batches):
        found = {kind: _Smallest(n) for kind, n in most.items()}
        for batch in batches:
            for text in texts(batch, text_col):
                base = base_spans(text)
                for _, kind, _, value in base:
                    found[KINDS[kind]].add(value)
                for _, _, token in candidates(text, base):
                    found[ORDINARY if len(token) >= LONG else ORDINARY_SHORT].add(token)
        for kind, few in found.items():
            rows = few.rows()
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([kind] * len(rows)), pa.array([h for h, _ in rows], pa.int64()), pa.array([t for _, t in rows], pa.string())],
                    names=["kind", "hash", "token"],
                )

    # Each task has kept its smallest hashes, so no table of tokens is sorted or shuffled.
    stage = Stage(docs.sparkSession, "formats")
    tokens = stage.keep(over_rows(docs, [text_col], run, "kind string, hash long, token string"), "tokens")
    labelled = {
        kind: [r["token"] for r in tokens.where(F.col("kind") == kind).select("hash", "token").distinct().orderBy("hash", "token").limit(n).collect()]
        for kind, n in most.items()
    }
    stage.drop("tokens")
    return learn({kind: words for kind, words in labelled.items() if words})


class _Smallest:
    """The distinct tokens with the smallest hashes, of those short enough to learn from."""

    def __init__(self, most: int) -> None:
        self._most = most
        self._held: dict[str, int] = {}
        self._bound = 1 << 63

    def add(self, token: str) -> None:
        if token in self._held or len(token) > LONGEST_LEARNED:
            return
        hash_ = xxhash.xxh64_intdigest(token) >> 1
        if hash_ < self._bound:
            self._held[token] = hash_
            if len(self._held) >= 4 * self._most:
                self._held = {t: h for h, t in self.rows()}
                self._bound = max(self._held.values())

    def rows(self) -> list[tuple[int, str]]:
        return sorted((h, t) for t, h in self._held.items())[:self._most]


def spans(text: str, formats: Formats, verdicts: Memo | None = None) -> list[tuple[int, int, int]]:
    """All spans (start, kind, end): those of the patterns, and tokens the automata take for secrets."""
    base = base_spans(text)
    found = [(s, k, e) for s, k, e, _ in base]
    for start, end, token in candidates(text, base):
        if formats.is_secret(token) if verdicts is None else verdicts[token]:
            found.append((start, 3, end))
    return sorted(found)


def joined(found: Iterable[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in found)


def scan(docs: DataFrame, formats: Formats) -> DataFrame:
    """Secrets of every whole text: doc_id, n_assign, n_access, n_hex, base_sha256 (of the pattern spans,
    joined), spans (all of them), n_format (those only the automata find).

    A span is kind:start:end in code points, end exclusive, ordered by start and kind, comma-joined. A null
    or empty text has none. Rows that repeat are returned as often; a null doc_id stays null. Texts of any length are
    scanned whole. An empty table gives an empty table. Other columns are not read, whatever their names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(formats)

    def run(batches):
        verdicts = Memo(shared.value.is_secret)
        for batch in batches:
            rows = []
            for text in texts(batch):
                found = spans(text, shared.value, verdicts)
                base = [s for s in found if s[1] < 3]
                n = [sum(s[1] == k for s in found) for k in range(4)]
                rows.append((*n[:3], hashlib.sha256(joined(base).encode()).hexdigest(), joined(found), n[3]))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            columns = list(zip(*rows)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_format"],
            )

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_format long"
    return over_rows(docs, ["doc_id", "text"], run, schema)


def redact(text: str | None, formats: Formats, mask: str = "[secret]", verdicts: Memo | None = None) -> str | None:
    """The text with every span replaced; overlapping spans become one mask."""
    if text is None:
        return None
    out, at = [], 0
    for start, _, end in spans(text, formats, verdicts):
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]]) if out else text


def redacted(docs: DataFrame, formats: Formats, text_col: str = "text", mask: str = "[secret]") -> DataFrame:
    """The same rows and columns, with every secret in the text replaced by the mask.

    Null stays null. Repeated rows stay, texts of any length are masked whole, an empty table gives an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(formats)
    at = docs.columns.index(text_col)

    def run(batches):
        verdicts = Memo(shared.value.is_secret)
        for batch in batches:
            masked = [redact(t, shared.value, mask, verdicts) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, text_col, pa.array(masked, pa.string()))

    return with_rows(docs, run)
