"""Personal data by patterns and a skip-chain conditional random field.

Patterns give the base spans, which stay. The field's nodes are the tokens of a text that could belong to
such data: tokens with a digit or an at sign, and other tokens that repeat a part of one. Neighbouring nodes share a
chain potential; nodes with the same or a similar core, however far apart, share a skip potential. Tokens
in base spans are observed. Loopy message passing carries their labels to the others, and tokens that
come out as personal data become added spans, so that a number or a mail name that stands in the text again in
another dress gets the same label.

Node and chain weights are fitted by pseudo-likelihood on a bounded sample of documents, labelled by the
patterns. Skip weights have a prior in favour of agreement, as repeats are rare in the sample.
Similar nodes are linked from one occurrence to the next and to the nearest observed ones on both sides, never all
with all. Messages run until they settle.

Defined results: a null or empty text has no spans; a text of any length is read whole, by steps in
proportion to its length; every text with a node is scored, whether or not a pattern matches in it; repeated rows get
equal results; without any base span in the sample only base spans come out; only the key and text columns are read. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelane.llm._common import documents, keyed_text, map_slices, slices, tidy

KINDS = ("email", "ip", "card", "phone")
LABELS = ("", *KINDS)
#: Documents that the fit sees, about.
SAMPLE_DOCS = 3000
#: Belief from which a token that no pattern found is personal data.
MIN_BELIEF = 0.7
#: Rounds after which messages that do not settle are taken as they are.
ROUNDS = 1000
SKIP_AGREEMENT = 3.0
#: Most that a token's own features say against a label, so that a near repeat can outweigh them.
MAX_LOCAL = 3.5

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Begins where a word begins, so that a long word is looked at once.
_NODE = re.compile(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*[0-9@][^\x20\x09-\x0D]*")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_OUTER = ".,;:!?\"'<>[]{}«»"


class Span(NamedTuple):
    start: int
    end: int
    kind: str


def luhn(digits: str) -> bool:
    total = 0
    for at, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + at % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def email_spans(text: str) -> list[Span]:
    """Leftmost matches, found from each at sign outwards, so that long runs of letters cost nothing."""
    spans, free, at = [], 0, text.find("@")
    while at >= 0:
        start = free + len(text[free:at].rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            spans.append(Span(start, domain.end(), "email"))
        free = domain.end() if domain else at + 1
        at = text.find("@", free)
    return spans


def base_spans(text: str) -> list[Span]:
    """Spans of the four patterns, by start and then by kind as listed."""
    spans = email_spans(text) if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            spans.append(Span(m.start(), m.end(), "ip"))
    for m in _CARD.finditer(text):
        digits = re.sub("[ -]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            spans.append(Span(m.start(), m.end(), "card"))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                spans.append(Span(m.start(), m.end(), "phone"))
    return sorted(spans, key=lambda s: (s.start, KINDS.index(s.kind)))


# -- the field ---------------------------------------------------------------------
class Graph(NamedTuple):
    starts: list[int]
    ends: list[int]
    features: list[list[str]]
    observed: np.ndarray  # label number, -1: none
    chain: list[tuple[int, int]]
    skip: list[tuple[int, int, float]]  # and how strong the likeness is, up to 1


def shape(token: str) -> str:
    """Classes of characters, runs of one class once, lengths of digit runs kept up to 5."""
    out = re.sub(r"[A-Z]+", "A", re.sub(r"[a-z]+", "a", token))
    return re.sub(r"[0-9]+", lambda m: "9" * min(5, len(m[0])), out)[:24]


def cores(token: str) -> list[str]:
    """What makes tokens similar: letters and digits alone, a mail name, the last seven digits."""
    plain = "".join(c for c in token if c.isalnum()).lower()
    found = [plain] if len(plain) >= 3 else []
    name, sign, _ = token.partition("@")
    if sign and len(name) >= 5:
        found.append("".join(c for c in name if c.isalnum()).lower())
    digits = "".join(c for c in token if "0" <= c <= "9")
    if len(digits) >= 7:
        found.append(digits[-7:])
    return list(dict.fromkeys(found))


def build_graph(text: str, base: list[Span]) -> Graph | None:
    """The field over a text, or None if no token is open to question."""
    places = [(m.start(), m.end()) for m in _NODE.finditer(text)]
    if not places:
        return None
    names = {c for s in base if s.kind == "email" for c in cores(text[s.start : s.end])[1:2]}
    if names:  # a mail name may stand alone, without digits
        found = {p for p in places}
        for m in _TOKEN.finditer(text):
            if (m.start(), m.end()) not in found and "".join(c for c in m[0] if c.isalnum()).lower() in names:
                found.add((m.start(), m.end()))
        places = sorted(found)
    starts, ends = [], []
    for a, b in places:
        token = text[a:b]
        a += len(token) - len(token.lstrip(_OUTER))
        b -= len(token) - len(token.rstrip(_OUTER))
        starts.append(a)
        ends.append(max(a, b))
    observed = np.full(len(starts), -1)
    for s in reversed(base):  # the first span of a token decides
        first = int(np.searchsorted(ends, s.start, side="right"))
        for k in range(first, len(starts)):
            if starts[k] >= s.end:
                break
            observed[k] = LABELS.index(s.kind)
    shapes = [shape(text[a:b]) for a, b in zip(starts, ends)]
    features = []
    for k, (a, b) in enumerate(zip(starts, ends)):
        digits = [c for c in text[a:b] if "0" <= c <= "9"]
        near_left = k > 0 and a - ends[k - 1] <= 2
        near_right = k + 1 < len(starts) and starts[k + 1] - b <= 2
        features.append([
            "bias", f"s={shapes[k]}", f"d={min(20, len(digits))}", f"at={'@' in text[a:b]}", f"dots={min(4, text.count('.', a, b))}",
            f"l={shapes[k - 1] if near_left else '-'}", f"r={shapes[k + 1] if near_right else '-'}",
        ])
    chain = [(k - 1, k) for k in range(1, len(starts)) if starts[k] - ends[k - 1] <= 2]
    last: dict[str, int] = {}
    anchor: dict[str, int] = {}  # the last token with the core that is observed
    skip: dict[tuple[int, int], float] = {}
    for k, (a, b) in enumerate(zip(starts, ends)):
        for core in cores(text[a:b]):
            for before in {last.get(core, k), anchor.get(core, k)} - {k}:  # short cores repeat by chance
                skip[before, k] = max(skip.get((before, k), 0.0), min(1.0, len(core) / 7))
            last[core] = k
            if observed[k] > 0:
                anchor[core] = k
    anchor.clear()
    for k in range(len(starts) - 1, -1, -1):  # and the next one that is observed
        for core in cores(text[starts[k] : ends[k]]):
            if observed[k] > 0:
                anchor[core] = k
            elif core in anchor:
                pair = k, anchor[core]
                skip[pair] = max(skip.get(pair, 0.0), min(1.0, len(core) / 7))
    return Graph(starts, ends, features, observed, chain, [(a, b, s) for (a, b), s in sorted(skip.items())])


class Field(NamedTuple):
    node: dict[str, np.ndarray]  # feature -> a weight for each label
    chain: np.ndarray  # label by label
    skip: np.ndarray


def beliefs(graph: Graph, field: Field, rounds: int = ROUNDS) -> np.ndarray:
    """Label distribution of each node after loopy message passing (sum-product, in logs)."""
    n, labels = len(graph.starts), len(LABELS)
    local = np.zeros((n, labels))
    for k, names in enumerate(graph.features):
        for name in names:
            if name in field.node:
                local[k] += field.node[name]
    local = np.maximum(local, local.max(axis=1, keepdims=True) - MAX_LOCAL)
    seen = graph.observed >= 0
    local[seen] = -50.0
    local[seen, graph.observed[seen]] = 0.0
    pairs = [(a, b, field.chain) for a, b in graph.chain] + [(a, b, strength * field.skip) for a, b, strength in graph.skip]
    if pairs:
        source = np.array([p for a, b, _ in pairs for p in (a, b)])
        target = np.array([p for a, b, _ in pairs for p in (b, a)])
        weight = np.stack([w for _, _, e in pairs for w in (e, e.T)])
        reverse = np.arange(len(source)) ^ 1
        message = np.zeros((len(source), labels))
        total = local.copy()
        for _ in range(rounds):
            out = (total[source] - message[reverse])[:, :, None] + weight
            top = out.max(axis=1)
            new = top + np.log(np.exp(out - top[:, None, :]).sum(axis=1))
            new -= new.max(axis=1, keepdims=True)
            change = np.abs(new - message).max()
            message = 0.5 * (message + new)  # damped, so that loops settle
            total = local.copy()
            np.add.at(total, target, message)
            if change < 1e-3:
                break
    else:
        total = local
    total = total - total.max(axis=1, keepdims=True)
    share = np.exp(total)
    return share / share.sum(axis=1, keepdims=True)


def added_spans(text: str, base: list[Span], field: Field | None, least: float = MIN_BELIEF) -> list[Span]:
    """Spans of the field that no base span touches."""
    graph = build_graph(text, base) if field is not None else None
    if graph is None or (graph.observed >= 0).all():
        return []
    share = beliefs(graph, field)
    label = share.argmax(axis=1)
    spans: list[Span] = []
    for k in range(len(graph.starts)):
        if graph.observed[k] >= 0 or label[k] == 0 or share[k, label[k]] < least:
            continue
        kind = LABELS[label[k]]
        if spans and spans[-1].kind == kind and graph.starts[k] - spans[-1].end <= 1 and k and graph.observed[k - 1] < 0:
            spans[-1] = Span(spans[-1].start, graph.ends[k], kind)
        else:
            spans.append(Span(graph.starts[k], graph.ends[k], kind))
    return [s for s in spans if s.end > s.start]


def fit_field(graphs: list[Graph], rounds: int = 60, rate: float = 0.5) -> Field | None:
    """Weights of greatest pseudo-likelihood; tokens outside base spans are labelled as none."""
    if not any((g.observed > 0).any() for g in graphs):
        return None
    labels = len(LABELS)
    names = sorted({f for g in graphs for node in g.features for f in node})
    number = {f: i for i, f in enumerate(names)}
    node_row, node_feature, y, chain, base = [], [], [], [], 0
    for g in graphs:
        for k, node in enumerate(g.features):
            node_row.extend([base + k] * len(node))
            node_feature.extend(number[f] for f in node)
        y.extend(np.maximum(g.observed, 0).tolist())
        chain.extend((base + a, base + b) for a, b in g.chain)
        base += len(g.features)
    node_row, node_feature, y = np.array(node_row), np.array(node_feature), np.array(y)
    truth = np.eye(labels)[y]
    weights, pair = np.zeros((len(names), labels)), np.zeros((labels, labels))
    seen, seen_pair = np.full(weights.shape, 1e-8), np.full(pair.shape, 1e-8)
    left, right = (np.array(c, int) for c in zip(*chain)) if chain else (np.zeros(0, int), np.zeros(0, int))
    for _ in range(rounds):
        score = np.zeros((len(y), labels))
        for c in range(labels):
            score[:, c] = np.bincount(node_row, weights[node_feature, c], minlength=len(y))
        np.add.at(score, right, pair[y[left]])
        np.add.at(score, left, pair.T[y[right]])
        score -= score.max(axis=1, keepdims=True)
        share = np.exp(score)
        gap = (share / share.sum(axis=1, keepdims=True) - truth) / len(y)
        grad = np.column_stack([np.bincount(node_feature, gap[node_row, c], minlength=len(names)) for c in range(labels)]) + 1e-5 * weights
        by_pair = np.zeros_like(pair)
        np.add.at(by_pair, y[left], gap[right])
        np.add.at(by_pair.T, y[right], gap[left])
        by_pair += 1e-5 * pair
        seen += grad * grad
        seen_pair += by_pair * by_pair
        weights -= rate * grad / np.sqrt(seen)
        pair -= rate * by_pair / np.sqrt(seen_pair)
    agreement = SKIP_AGREEMENT * np.diag([1.0] + [2.0] * len(KINDS))
    return Field({f: weights[i] for f, i in number.items()}, pair, agreement)


# -- Spark -------------------------------------------------------------------------
def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Field | None:
    """A field from about ``sample_docs`` documents with base spans, chosen by the hash of their key."""
    rows = keyed_text(docs).where(F.col("text").rlike("[0-9@]"))
    size = rows.count()
    draw = (F.xxhash64(F.lit("crf"), "doc_id", "text") / F.lit(2.0**64)) + 0.5
    chosen = rows.where(draw < min(1.0, sample_docs / max(1, size)))
    node = pa.struct([("observed", pa.int32()), ("features", pa.list_(pa.string()))])
    schema = "nodes array<struct<observed:int,features:array<string>>>, chain array<int>"

    def work(batch: pa.RecordBatch) -> dict:
        nodes, chain = [], []
        for text in batch.column("text").to_pylist():
            graph = build_graph(text, base_spans(text))
            if graph is not None:
                nodes.append([{"observed": int(o), "features": f} for o, f in zip(graph.observed, graph.features)])
                chain.append([b for _, b in graph.chain])
        return {"nodes": pa.array(nodes, pa.list_(node)), "chain": pa.array(chain, pa.list_(pa.int32()))}

    graphs = []
    for row in map_slices(chosen, work, schema).toArrow().to_pylist():
        features = [n["features"] for n in row["nodes"]]
        graphs.append(Graph([0] * len(features), [0] * len(features), features, np.array([n["observed"] for n in row["nodes"]]), [(b - 1, b) for b in row["chain"]], []))
    graphs.sort(key=lambda g: (g.features, g.observed.tolist()))  # not the order of arrival
    return fit_field(graphs)


def sent(spark: SparkSession, field: Field | None):
    """A broadcast of plain parts, so that workers need no import: features of the bounded sample at most."""
    return spark.sparkContext.broadcast(field and tuple(field))


SPAN = "struct<kind:string,start:int,end:int,base:boolean>"


def find_spans(df: DataFrame, field: Field | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text, spans`` of every row, spans by start and kind; no shuffle."""
    rows = keyed_text(df, key, text)
    shared = sent(rows.sparkSession, field)
    struct = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))

    def work(batch: pa.RecordBatch) -> dict:
        own, found = shared.value and Field(*shared.value), []
        for text in batch.column("text").to_pylist():
            base = base_spans(text)
            spans = [(s, True) for s in base] + [(s, False) for s in added_spans(text, base, own)]
            spans.sort(key=lambda x: (x[0].start, KINDS.index(x[0].kind)))
            found.append([{"kind": s.kind, "start": s.start, "end": s.end, "base": b} for s, b in spans])
        return {"doc_id": batch.column("doc_id"), "text": batch.column("text"), "spans": pa.array(found, struct)}

    kind = dict(rows.dtypes)["doc_id"]
    return map_slices(rows, work, f"doc_id {kind}, text string, spans array<{SPAN}>")


def redact_text(text: str, spans: list[Span]) -> str:
    """The text with each stretch that spans cover replaced by the kind of its first span, as ``<EMAIL>``."""
    out, at = [], 0
    for s in sorted(spans):
        if s.start >= at:
            out.extend((text[at : s.start], f"<{s.kind.upper()}>"))
        at = max(at, s.end)
    return "".join(out) + text[at:]


def redact(df: DataFrame, field: Field | None, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The rows of ``df`` with all their columns, personal data replaced; ``n_chars`` follows, null stays null."""
    shared = sent(df.sparkSession, field)

    def run(batches):
        own = shared.value and Field(*shared.value)
        for batch in (p for whole in batches for p in slices(whole, text=text)):
            texts, lengths = batch.column(text).to_pylist(), batch.column(n_chars).to_pylist()
            for k, t in enumerate(texts):
                base = base_spans(t or "")
                spans = base + added_spans(t or "", base, own)
                if spans:
                    texts[k] = redact_text(t, spans)
                    lengths[k] = len(texts[k])
            for name, values in ((text, texts), (n_chars, lengths)):
                at = batch.schema.get_field_index(name)
                batch = batch.set_column(at, batch.schema.field(at), pa.array(values, batch.schema.field(at).type))
            yield batch

    return df.mapInArrow(tidy(run), df.schema)


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op1_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every whole document."""
    docs = documents(spark, sf_dir)
    found = find_spans(docs, train(docs))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, KINDS), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size(base)).cast("long").alias("n_added"),
    )
