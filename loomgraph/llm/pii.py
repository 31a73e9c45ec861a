"""Operator 5: personal data by weak supervision.

Candidates are spans that might be personal data: the base matches of email,
ip, card and phone, and further ones that only look like it (national phone
numbers, social security and bank account shapes, secrets after a label, names
after a form of address). Several labelers vote on each: shape rules (regex),
a gazetteer of lists, and words around the span (context). The counts of vote
patterns over *all* candidates are small whatever the corpus; from them
expectation-maximisation estimates each labeler's reliability for each kind
without any labelled data, and the resulting posteriors train the final span
classifier, a logistic regression over votes and shape features. Base matches
are always kept; other candidates stay if the classifier accepts them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.llm._shared import Stash, documents

# Fixed patterns of the base kinds.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
KINDS = ("email", "ip", "card", "phone")

# Patterns of further candidates.
NATIONAL = re.compile(r"(?<![\w+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![\w-])")
SOCIAL = re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])")
ACCOUNT = re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?!\w)")
SECRET = re.compile(r"\b(?:token|secret|password|passwd|api[_-]?key)\b\s*[:=]\s*[\"']?([A-Za-z0-9+/_-]{12,})", re.I)
PERSON = re.compile(r"\b(?:Mr|Mrs|Ms|Dr|Herr|Frau|Monsieur|Madame|Mme|Señor|Señora)\.?\x20([^\W\d_]+(?:\x20[A-ZÀ-Ý][^\W\d_]+)?)")
EXTRA = (("phone", NATIONAL, 0), ("ssn", SOCIAL, 0), ("iban", ACCOUNT, 0), ("secret", SECRET, 1), ("name", PERSON, 1))
ALL_KINDS = (*KINDS, "ssn", "iban", "secret", "name")

# Gazetteers and context words: fixed values.
TOP_DOMAINS = frozenset("com org net edu gov mil int io ai app dev info biz name de fr es it nl be at ch uk ie pt pl cz se no dk fi gr eu us ca mx br ar cl co au nz jp cn in kr za ru tr test example".split())
RESERVED_NET = ("0.", "127.", "255.")
CARD_PREFIX = ("34", "37", "4", "51", "52", "53", "54", "55", "6011", "65", "35", "36", "38")
COUNTRY_CODES = ("1", "33", "34", "49", "44", "39", "31", "41", "43", "52", "54")
COUNTRIES = frozenset("DE FR ES GB IT NL BE AT CH PT IE LU PL".split())
GIVEN_NAMES = frozenset(
    "adam alejandro alice ana andrea andreas andrew angela anna anne anthony antoine antonio barbara beatriz ben bernd camille carla carlos carmen "
    "catherine charles charlotte chloe christian christine christopher claire clara claudia daniel david diego dieter elena elizabeth emily emma eric "
    "ernst eva fabian felix fernando francisco francois frank franz frieda gabriel george gerhard hannah hans heinrich helen helga helmut henri ines "
    "isabel jack jacques james jan javier jean jennifer jessica joan johanna john jorge jose joseph juan julia julie jurgen karen karl katharina klaus "
    "laura leon lisa louis louise lucas lucia luis luise luke manuel marc maria marie mark marta martin mary matthew max michael michel miguel monika "
    "nicolas olivia oscar pablo patricia paul paula pedro peter petra philippe pierre rafael ramon richard robert rosa ruth samuel sandra sara sarah "
    "sebastian sergio simon sofia sophie stefan stephan susan sylvie teresa theo thomas ursula victor walter werner william wolfgang yves".split()
)
CONTEXT = {
    "email": "mail email e-mail contact write @ courriel correo".split(),
    "ip": "ip address server host addr from adresse".split(),
    "card": "card visa credit payment karte carte tarjeta number".split(),
    "phone": "phone tel call mobile fax telefon téléphone teléfono".split(),
    "ssn": "ssn social security".split(),
    "iban": "iban account konto compte cuenta bank".split(),
    "secret": "token secret password key".split(),
    "name": "mr mrs ms dr herr frau name monsieur madame señor".split(),
}
LABELERS = 3  # shape, gazetteer, context; each votes -1, 0 or 1
FEATURES = 8  # votes (3), base, long, boundary left, boundary right, intercept


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d *= 2
            d -= 9 * (d > 9)
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of EMAIL in one pass: from each @ to the left over the local part, to the right over the host."""
    done, at = 0, text.find("@")
    while at >= 0:
        lo = at
        while lo > done and text[lo - 1] in _LOCAL:
            lo -= 1
        host = _HOST.match(text, at + 1) if lo < at else None
        if host:
            yield lo, host.end()
        # what is left of an @ is no part of a later match, and the first one takes its whole host
        done = host.end() if host else at + 1
        at = text.find("@", done)


_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_NUMBER = re.compile(r"[0-9]+")


def _addresses(text: str) -> Iterator[tuple[int, int, list[str]]]:
    """Matches of IP in one pass, with their parts: each four numbers of a dotted chain."""
    for chain in _CHAIN.finditer(text):
        if text.find(".", chain.start(), chain.end()) < 0:
            continue
        spots = [m.span() for m in _NUMBER.finditer(text, *chain.span())]
        for i in range(0, len(spots) - 3, 4):
            yield spots[i][0], spots[i + 3][1], [text[a:b] for a, b in spots[i : i + 4]]


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base matches by start, then kind in the order of KINDS; code points, end exclusive."""
    out = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        if "." in text:
            for a, b, parts in _addresses(text):
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in parts):
                    out.append((a, 1, b))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 12:
                d = _digits(m.group())
                if 12 <= len(d) <= 19 and luhn(d):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= len(_digits(m.group())) <= 15:
                    out.append((m.start(), 3, m.end()))
    return [(KINDS[k], a, b) for a, k, b in sorted(out)]


_DIGIT = re.compile(r"[0-9]")


def extra_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Further candidates that overlap neither a base match nor one another."""
    out: list[tuple[str, int, int]] = []
    taken = sorted((a, b) for _, a, b in base)
    starts = [a for a, _ in taken]

    def free(a: int, b: int) -> bool:
        from bisect import bisect_left

        i = bisect_left(starts, a)
        return (i == len(taken) or taken[i][0] >= b) and (i == 0 or taken[i - 1][1] <= a)

    digits = _DIGIT.search(text) is not None
    for kind, pattern, group in EXTRA:
        if kind in ("phone", "ssn", "iban") and not digits or kind == "secret" and "=" not in text and ":" not in text:
            continue
        found = [m.span(group) for m in pattern.finditer(text)]
        for a, b in found:
            if free(a, b):
                out.append((kind, a, b))
                from bisect import insort

                insort(taken, (a, b))
                insort(starts, a)
    return out


def votes(text: str, kind: str, a: int, b: int) -> tuple[int, int, int]:
    """Shape, gazetteer and context vote on a span: 1 for, -1 against, 0 none."""
    span = text[a:b]
    d = _digits(span)
    near = {w.strip(".,:;!?()\"'=").lower() for w in text[max(0, a - 40) : a].split() + text[b : b + 24].split()}
    context = 1 if near.intersection(CONTEXT[kind]) else 0
    if kind == "email":
        local, _, host = span.partition("@")
        shape = 1 if local.strip("._%+-") and not host.startswith("-") and ".." not in local else -1
        gaz = 1 if host.rpartition(".")[2].lower() in TOP_DOMAINS else 0
    elif kind == "ip":
        shape = 1 if all(p == "0" or p[0] != "0" for p in span.split(".")) and text[b : b + 1] != "." else -1
        gaz = -1 if span.startswith(RESERVED_NET) else 1
    elif kind == "card":
        shape = 1 if len(d) in (13, 15, 16, 19) and len(set(d)) > 2 else -1
        gaz = 1 if d.startswith(CARD_PREFIX) else -1
    elif kind == "phone":
        shape = 1 if 10 <= len(d) <= 13 and len(set(d)) > 2 else -1
        gaz = 1 if span[0] != "+" or d.startswith(COUNTRY_CODES) else -1
    elif kind == "ssn":
        shape = 1 if d[:3] not in ("000", "666") and d[3:5] != "00" and d[5:] != "0000" and d[0] != "9" else -1
        gaz = 0
    elif kind == "iban":
        s = span.replace(" ", "")
        number = "".join(str(int(c, 36)) for c in s[4:] + s[:4])
        shape = 1 if int(number) % 97 == 1 else -1
        gaz = 1 if span[:2] in COUNTRIES else -1
    elif kind == "secret":
        shape = 1 if any(c.isdigit() for c in span) and any(c.isalpha() for c in span) else -1
        gaz = 1 if re.fullmatch(r"[0-9a-fA-F]{16,}|[A-Za-z0-9+/_-]{24,}", span) else 0
    else:
        shape = 1 if span[:1].isupper() else -1
        gaz = 1 if span.split(" ")[0].lower() in GIVEN_NAMES else 0
    return shape, gaz, context


def pattern_of(text: str, kind: str, a: int, b: int, base: bool) -> int:
    """Votes and shape features of a span as one small number."""
    v = votes(text, kind, a, b)
    out = 0
    for x in v:
        out = out * 3 + x + 1
    for flag in (base, b - a > 20, a == 0 or text[a - 1].isspace(), b == len(text) or text[b].isspace()):
        out = out * 2 + bool(flag)
    return out


def decode(pattern: int) -> np.ndarray:
    """The features of a pattern: three votes, base, long, free left, free right, 1."""
    flags = [pattern >> i & 1 for i in (3, 2, 1, 0)]
    p, v = pattern >> 4, []
    for _ in range(LABELERS):
        v.append(p % 3 - 1)
        p //= 3
    return np.array([*v[::-1], *flags, 1], float)


def reliabilities(counts: dict[int, int], rounds: int = 50) -> dict[int, float]:
    """EM over one kind's vote patterns: posterior that a span with the pattern is real.

    Two hidden classes; given the class, labelers vote independently, each with
    its own table of probabilities. Rates start in favour of the labelers and
    are smoothed by pseudo-counts, so that a kind with few spans stays there.
    """
    pats = sorted(counts)
    x = np.array([decode(p)[:LABELERS] for p in pats], int) + 1
    n = np.array([counts[p] for p in pats], float)
    prior = np.array([[0.15, 0.3, 0.55], [0.55, 0.3, 0.15]])  # real, not; votes -1, 0, 1
    table = np.repeat(prior[:, None, :], LABELERS, axis=1)
    share = 0.5
    for _ in range(rounds):
        log = np.stack([np.log(s) + sum(np.log(table[c, j, x[:, j]]) for j in range(LABELERS)) for c, s in ((0, share), (1, 1 - share))])
        post = 1 / (1 + np.exp(np.clip(log[1] - log[0], -50, 50)))
        for c, p in ((0, post), (1, 1 - post)):
            w = n * p
            for j in range(LABELERS):
                table[c, j] = (np.bincount(x[:, j], w, 3) + 10 * prior[c]) / (w.sum() + 10)
        share = min(0.99, max(0.01, (float(n @ post) + 1) / (n.sum() + 2)))
    return dict(zip(pats, post.tolist()))


def train(counts: dict[tuple[str, int], int], ridge: float = 1.0, rounds: int = 25) -> dict[str, np.ndarray]:
    """Weights of the span classifier for each kind, from counts of (kind, pattern)."""
    model = {}
    for kind in ALL_KINDS:
        own = {p: n for (k, p), n in counts.items() if k == kind}
        if not own:
            continue
        votes_only: dict[int, int] = {}
        for p, n in own.items():
            votes_only[p >> 4 << 4] = votes_only.get(p >> 4 << 4, 0) + n
        post = reliabilities(votes_only)
        x = np.stack([decode(p) for p in own])
        y = np.array([post[p >> 4 << 4] for p in own])
        n = np.array(list(own.values()), float)
        n *= min(1.0, 1e6 / n.sum())  # counts keep their proportions whatever the corpus
        w = np.zeros(FEATURES)
        for _ in range(rounds):  # Newton steps
            q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            grad = x.T @ (n * (q - y)) + ridge * w
            w -= np.linalg.solve(x.T @ (x * (n * np.maximum(q * (1 - q), 1e-6))[:, None]) + ridge * np.eye(FEATURES), grad)
        model[kind] = w
    return model


def accepts(model: dict[str, np.ndarray], kind: str, pattern: int) -> bool:
    """Whether the classifier takes the span for personal data."""
    return kind in model and float(decode(pattern) @ model[kind]) > 0


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("pattern", pa.int32())])
SPAN_DDL = "array<struct<kind:string,start:bigint,end:bigint,pattern:int>>"


def candidates(text: str) -> list[dict]:
    base = base_spans(text)
    return [{"kind": k, "start": a, "end": b, "pattern": pattern_of(text, k, a, b, i < len(base))} for i, (k, a, b) in enumerate(base + extra_spans(text, base))]


def is_base(pattern: int) -> bool:
    return bool(pattern >> 3 & 1)


def scan(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` of every row and its candidates ``found``; null text counts as empty."""
    src = docs.select(*keep, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_loom_text"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in it:
            for at in range(0, big.num_rows, 500):
                b = big.slice(at, 500)
                found = [candidates(t) for t in b.column(b.num_columns - 1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(found, pa.list_(SPAN))], names=[*b.schema.names[:-1], "found"])

    from pyspark.sql.types import _parse_datatype_string

    return src.mapInArrow(run, src.drop("_loom_text").schema.add("found", _parse_datatype_string(SPAN_DDL)))


def learn(found: DataFrame) -> dict[str, np.ndarray]:
    """The classifier from all candidates: at most kinds * 27 * 16 counts reach the driver."""
    c = found.select(F.explode("found").alias("s")).groupBy("s.kind", "s.pattern").agg(F.count("*").alias("n"))
    return train({(r.kind, r.pattern): r.n for r in c.collect()})


def detect(stash: Stash, docs: DataFrame, keep: list[str], text: str = "text") -> tuple[DataFrame, dict[str, np.ndarray]]:
    """Candidates of every row, written down, and the classifier learned from them."""
    found = stash.put(scan(docs, keep, text), "candidates")
    return found, learn(found)


def _digest(found: list[dict], model: dict[str, np.ndarray]) -> tuple[list[int], str, str]:
    order = {k: i for i, k in enumerate(ALL_KINDS)}
    line = lambda spans: ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in sorted(spans, key=lambda s: (s["start"], order[s["kind"]], s["end"])))
    base = [s for s in found if is_base(s["pattern"])]
    more = [s for s in found if is_base(s["pattern"]) or accepts(model, s["kind"], s["pattern"])]
    return [sum(s["kind"] == k for s in base) for k in KINDS], hashlib.sha256(line(base).encode()).hexdigest(), line(more)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all whole documents: base counts and digest, and all spans.

    Null and empty texts have none. Rows that repeat get the same answer, a null
    doc_id stays null, and other columns are ignored. Texts are scanned in time
    linear in their length. An empty table gives no rows.
    """
    found, model = detect(Stash(spark, "pii"), documents(spark, sf_dir), ["doc_id"])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            out = [_digest(f, model) for f in b.column(1).to_pylist()]
            cols = [pa.array([o[0][i] for o in out], pa.int64()) for i in range(4)]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols, pa.array([o[1] for o in out], pa.string()), pa.array([o[2] for o in out], pa.string())], names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return found.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with each detected span replaced by its kind in brackets.

    Overlapping spans are replaced as one, named after the first. Rows without
    personal data and null texts stay as they are. ``n_chars``, if there, is
    counted anew for texts that change.
    """
    stash = Stash(docs.sparkSession, "pii")
    model = learn(stash.put(scan(docs, [], text), "candidates"))
    names = docs.columns
    at_text, at_n = names.index(text), names.index("n_chars") if "n_chars" in names else -1

    def clean(t: str | None) -> str | None:
        if not t:
            return t
        spans = sorted((s["start"], s["end"], s["kind"]) for s in candidates(t) if is_base(s["pattern"]) or accepts(model, s["kind"], s["pattern"]))
        out, done, end = [], 0, -1
        for a, b, k in spans:
            if a >= end:
                out += [t[done:a], f"[{k}]"]
            end = done = max(end, b)
        return "".join(out) + t[done:]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in it:
            for at in range(0, big.num_rows, 500):
                b = big.slice(at, 500)
                cols = list(b.columns)
                before = b.column(at_text).to_pylist()
                after = [clean(t) for t in before]
                cols[at_text] = pa.array(after, b.schema.field(at_text).type)
                if at_n >= 0:
                    n = [m if x == y else len(y) for m, x, y in zip(b.column(at_n).to_pylist(), before, after)]
                    cols[at_n] = pa.array(n, b.schema.field(at_n).type)
                yield pa.RecordBatch.from_arrays(cols, names=b.schema.names)

    return docs.mapInArrow(run, docs.schema)
