"""Personal data by pattern matching and a skip-chain conditional random field.

Base spans come from exact patterns. Candidate tokens (anything that looks like a
number in groups or an address) are the nodes of a CRF over the labels none, email,
ip, card and phone: node potentials by token shape, chain edges between successive
candidates, and skip edges between distant tokens with the same content (equal
digits, equal folded address). Loopy max-marginal messages along the edges make
labels consistent across a document, so a number that is plainly personal data in
one place is also found where it is written another way. Potentials are counted over
all documents, the base spans serving as labels. A token that no base pattern matches
is unlabelled and counts neither for nor against a label, and rates are mixed with even
ones, so no potential grows with the number of documents.

Skip edges form a ring over equal tokens, not all pairs, so work is linear in the
number of candidates. Base spans are never removed; added spans never overlap them.

Defined cases: null and empty texts have no spans; repeated rows are searched each
on their own; empty tables give no rows; extra columns are ignored; texts are read
whole.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base patterns, in the order in which spans are listed.
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
KINDS = tuple(PATTERNS)
LABELS = ("none", *KINDS)

_ADDRESS = re.compile(r"[A-Za-z0-9._%+-]+(?:@|\x20?[\[(](?:at|AT)[\])]\x20?)[A-Za-z0-9.-]+")
_NUMBER = re.compile(r"\+?\(?[0-9][\x20().0-9-]{5,}[0-9]")
_DIGIT = re.compile(r"[0-9]")
_EMAIL_CHARS = re.compile(r"[A-Za-z0-9._%+@-]+")
# The base patterns' own matches, without a second look at what a first one has passed: a
# match that fails from a run's first digit fails from its others, too.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(\.[A-Za-z0-9-]++)++")
_QUAD = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
#: A label is added only above this probability, and only with support of a skip edge.
SURE = 0.9
ROUNDS = 6


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _valid(kind: str, text: str) -> bool:
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in text.split("."))
    if kind == "card":
        digits = re.sub(r"[^0-9]", "", text)
        return 13 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(_DIGIT.findall(text)) <= 15
    return True


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the email pattern: at each @ in a run of its characters, the domain
    behind it and all of the run before it since the last match or @."""
    for run in _EMAIL_CHARS.finditer(text):
        begin, at = run.start(), text.find("@", run.start(), run.end())
        while at >= 0:
            domain = _DOMAIN.match(text, at, run.end()) if at > begin else None
            if domain:
                yield begin, domain.end()
            begin = domain.end() if domain else at + 1
            at = text.find("@", begin, run.end())


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The spans of the base patterns, by kind, then start."""
    out = []
    if "@" in text:
        out += [("email", a, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        for kind in KINDS[1:]:
            if kind == "phone" and "+" not in text:
                continue
            pattern = _QUAD if kind == "ip" else PATTERNS[kind]
            out += [(kind, *m.span()) for m in pattern.finditer(text) if _valid(kind, m.group())]
    return out


def _key(token: str) -> str:
    """What equal tokens share: folded address, or the last ten digits."""
    if "@" in token or "[" in token or "(at" in token.lower():
        return re.sub(r"\x20?[\[(]at[\])]\x20?", "@", token.lower()).strip(".-")
    return re.sub(r"[^0-9]", "", token)[-10:]


def _shape(token: str) -> str:
    """Discrete shape of a token: what its node potential is counted by."""
    if "@" in token:
        return "address" if PATTERNS["email"].fullmatch(token.strip(".-")) else "address?"
    if "[" in token or "(at" in token.lower():
        return "address-spelt"
    digits = re.sub(r"[^0-9]", "", token)
    size = len(digits)
    group = "s" if size < 9 else "m" if size < 13 else "l" if size < 20 else "x"
    dotted = len([p for p in token.split(".") if p.isdigit()]) == 4 and _valid("ip", token)
    return "".join((group, "+" if token[0] == "+" else "", "(" if "(" in token else "",
                    "." if dotted else "", "v" if 13 <= size <= 19 and luhn(digits) else "",
                    "r" if re.fullmatch(r"[0-9]+", token) else ""))


def candidates(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[int, int, str, str, int]]:
    """(start, end, shape, key, label by the base spans) of the CRF's nodes."""
    starts = sorted((a, b, k) for k, a, b in spans)
    out, i = [], 0
    found = []
    if "@" in text or "[at" in text or "(at" in text or "[AT" in text or "(AT" in text:
        found += _ADDRESS.finditer(text)
    taken = {i for m in found for i in range(*m.span())}
    found += (m for m in _NUMBER.finditer(text) if m.start() not in taken)
    for m in sorted(found, key=lambda m: m.start()):
        a, b = m.span()
        while i < len(starts) and starts[i][1] <= a:
            i += 1
        label = LABELS.index(starts[i][2]) if i < len(starts) and starts[i][0] < b else 0
        token = m.group().strip()
        out.append((a, b, _shape(token), _key(token), label))
    return out


def _skip_edges(nodes) -> list[tuple[int, int]]:
    """A ring over the tokens of each key."""
    groups = defaultdict(list)
    for i, (*_, key, _label) in enumerate(nodes):
        if len(key) >= 7:
            groups[key].append(i)
    out = []
    for g in groups.values():
        out += list(zip(g, g[1:]))
        if len(g) > 2:
            out.append((g[0], g[-1]))
    return out


def count_features(text: str) -> Counter:
    """Counts of (feature, label or label pair) in one text; pairs only where both are labelled."""
    found: Counter = Counter()
    nodes = candidates(text, base_spans(text))
    for *_, shape, _key, label in nodes:
        found[f"n:{shape}", label] += 1
    for x, y in zip(nodes, nodes[1:]):
        if x[4] and y[4]:
            found["c", x[4] * 8 + y[4]] += 1
    for i, j in _skip_edges(nodes):
        if nodes[i][4] and nodes[j][4]:
            found["s", int(nodes[i][4] == nodes[j][4])] += 1
    return found


class Crf:
    """Potentials (logs) and inference."""

    def __init__(self, counts: dict[tuple[str, int], int]):
        k = len(LABELS)
        shapes = {f[2:] for f, _ in counts if f.startswith("n:")}
        self.node = {s: self._logs([counts.get((f"n:{s}", v), 0) for v in range(1, k)]) for s in shapes}
        self.unseen = np.zeros(k)
        joint = self._rates([[counts.get(("c", a * 8 + b), 0) for b in range(1, k)] for a in range(1, k)])
        self.chain = np.zeros((k, k))  # nothing is known of what an unlabelled token is
        self.chain[1:, 1:] = 0.3 * np.log(joint / joint.sum(1, keepdims=True) / joint.sum(0, keepdims=True))
        # Equal content has one kind: 99 to 1 before anything is counted.
        agree = (counts.get(("s", 1), 0) + 99.0) / (counts.get(("s", 0), 0) + 1.0)
        self.skip = np.log(min(max(agree, 3.0), 1e3)) * np.eye(k)

    @staticmethod
    def _rates(n) -> np.ndarray:
        """Shares of the counts, half of them dealt evenly."""
        n = np.array(n, float)
        return 0.5 * n / max(n.sum(), 1.0) + 0.5 / n.size

    def _logs(self, n) -> np.ndarray:
        """Potentials of a shape: its labels' shares, and none as likely as the likeliest."""
        shares = np.log(self._rates(n)) if sum(n) else np.zeros(len(n))
        return np.concatenate(([shares.max()], shares))

    def marginals(self, nodes) -> np.ndarray:
        """Label probabilities of each node after loopy message passing."""
        k = len(LABELS)
        unary = np.array([self.node.get(s, self.unseen) for *_, s, _key, _l in nodes])
        skips = _skip_edges(nodes)
        known = np.array([n[4] for n in nodes])
        unary[known > 0] = -6.0
        unary[np.flatnonzero(known > 0), known[known > 0]] = 0.0  # base spans are given
        edges = [(i, i + 1, self.chain) for i in range(len(nodes) - 1)] + [(i, j, self.skip) for i, j in skips]
        messages = {(i, j): np.zeros(k) for a, b, _ in edges for i, j in ((a, b), (b, a))}
        for _ in range(ROUNDS):
            belief = unary.copy()
            for (_, j), m in messages.items():
                belief[j] += m
            fresh = {}
            for a, b, pot in edges:
                for i, j, p in ((a, b, pot), (b, a, pot.T)):
                    out = (belief[i] - messages[j, i])[:, None] + p
                    top = out.max(axis=0)
                    m = top + np.log(np.exp(out - top).sum(axis=0))
                    fresh[i, j] = 0.5 * messages[i, j] + 0.5 * (m - m.max())
            messages = fresh
        belief = unary.copy()
        for (_, j), m in messages.items():
            belief[j] += m
        p = np.exp(belief - belief.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)

    def added(self, text: str, base) -> list[tuple[str, int, int]]:
        """Spans beyond the base: nodes surely of a kind that a skip edge supports."""
        nodes = candidates(text, base)
        keys = {n[3] for n in nodes if n[4]}
        if not any(n[4] == 0 and n[3] in keys and len(n[3]) >= 7 for n in nodes):
            return []
        p = self.marginals(nodes)
        taken = sorted((a, b) for _, a, b in base)
        out = []
        for (a, b, _, key, label), q in zip(nodes, p):
            best = int(q.argmax())
            if label == 0 and best and q[best] >= SURE and key in keys and not any(
                    x < b and a < y for x, y in taken):
                token = text[a:b]
                out.append((LABELS[best], a + len(token) - len(token.lstrip()), b - len(token) + len(token.rstrip())))
        return out


def train(docs: DataFrame) -> Crf:
    """Count potentials over all documents; the driver gets one row per feature."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                text = text.as_py() or ""
                if "@" in text or _DIGIT.search(text):
                    total.update(count_features(text))
        yield pa.RecordBatch.from_arrays(
            [pa.array([f for f, _ in total], pa.string()), pa.array([v for _, v in total], pa.int64()),
             pa.array(list(total.values()), pa.int64())], ["feature", "label", "n"])

    rows = (docs.select("text").mapInArrow(run, "feature string, label bigint, n bigint")
            .groupBy("feature", "label").agg(F.sum("n").alias("n")).collect())
    return Crf({(r["feature"], r["label"]): r["n"] for r in rows})


def _joined(spans) -> str:
    order = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1]))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in order)


_OUT = ("doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
        "base_sha256 string, spans string")


def find(docs: DataFrame, crf: Crf) -> DataFrame:
    """Counts and digest of the base spans, and all spans, of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0), batch.column(1)):
                text = text.as_py() or ""
                base = base_spans(text)
                more = crf.added(text, base) if base else []
                n = Counter(k for k, *_ in base)
                digest = hashlib.sha256(_joined(base).encode()).hexdigest()
                rows.append((doc.as_py(), *(n[k] for k in KINDS), digest, _joined(base + more)))
            cols = list(zip(*rows)) if rows else [()] * 7
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             [c.split(" ")[0] for c in _OUT.split(", ")])
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, _OUT)
