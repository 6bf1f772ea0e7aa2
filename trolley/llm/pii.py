"""Personal data: exact base patterns, and a semi-Markov conditional random field for the rest.

The base kinds are found by fixed patterns. Around digits, @, a bracketed or spoken "at"
and long keys of letters the text is cut into tokens; every run of up to seven
tokens is a candidate segment, scored as a whole by its features, and a dynamic
program over bounded segments picks boundaries and kinds together. The field learns
from generated sentences and from the base spans of a bounded sample of documents;
its spans are added where no base span lies.
"""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.fitting import fit_in_task

#: The kinds in the order in which spans are listed; the first four are base kinds.
KINDS = ("email", "ip", "card", "phone", "secret")
BASE = KINDS[:4]
LABELS = ("", *KINDS)
LONGEST = 7
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
TRIGGER = re.compile(r"[0-9@]|(?i:[(\[]at[)\]]|(?<= )at (?=[a-z_-]+ dot ))|(?<![A-Za-z_-])[A-Za-z]?[a-z]*[A-Z_-][A-Za-z_-]{15}")
#: Longest segment of several tokens, and longest span that is tried as an address, in characters.
WIDEST = 80
TOKEN = re.compile(r"\S+")
FOUND = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind as listed, then start.

    An address must have @ directly behind its local part, so each @ is looked at once
    and its local part is read backwards, down to the match before; that is the
    leftmost match without rescanning long words.
    """
    out, done = [], 0
    if "@" in text:
        for m in DOMAIN.finditer(text):
            start = m.start()
            while start > done and text[start - 1] in LOCAL:
                start -= 1
            if start < m.start():
                out.append(("email", start, m.end()))
                done = m.end()
    for m in IP.finditer(text):
        if all(len(x) <= 3 and int(x or 0) <= 255 for x in (part.lstrip("0") for part in m[0].split("."))):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum(map(str.isdigit, m[0])) <= 15:
                out.append(("phone", *m.span()))
    return out


def listed(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


# --- candidate windows -----------------------------------------------------------------


def windows(text: str, context: int = 3):
    """Lists of (start, end) of tokens around triggers; tokens of a window stand side by side."""
    tokens: list[tuple[int, int]] = []
    last = -1
    at = 0
    for trigger in TRIGGER.finditer(text):
        if trigger.start() < at:
            continue
        start = trigger.start()
        while start > at and not text[start - 1].isspace():
            start -= 1
        end = TOKEN.match(text, start).end()
        before: list[tuple[int, int]] = []
        i = start
        while len(before) < context and i > max(at, 0):
            j = i
            while j > at and text[j - 1].isspace():
                j -= 1
            i = j
            while i > at and not text[i - 1].isspace():
                i -= 1
            if i == j:
                break
            before.append((i, j))
        if tokens and (not before or before[-1][0] > last + 1 and text[last : before[-1][0]].strip()):
            tail = [m.span() for _, m in zip(range(context), TOKEN.finditer(text, last), strict=False)]
            if before and tail and tail[-1][1] <= before[-1][0]:
                yield tokens + tail
                tokens = []
        tokens += [*reversed(before), (start, end)]
        last = at = end
    if tokens:
        yield tokens + [m.span() for _, m in zip(range(context), TOKEN.finditer(text, last), strict=False)]


LEAD, TRAIL = "\"'([{<=:#$%&*|~", "\"'.,;:!?)]}>#$%&*|~"
RELAXED = {
    "address": re.compile(r"[\w.%+-]+ ?[\[(]?(?:@|at)[\])]? ?[\w-]+(?:(?:\.| ?[\[(]dot[\])] ?)[\w-]+)+", re.A),
    "spoken": re.compile(r"[\w%+-]+(?: dot [\w%+-]+)* at [\w-]+(?: dot [\w-]+)+", re.A | re.I),
    "quad": re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?::[0-9]+)?"),
    "groups": re.compile(r"[0-9]{4}(?:[ -]?[0-9]{4}){3}"),
    "dial": re.compile(r"\+?[(0-9][ ().0-9-]{6,}[0-9]"),
    "hex": re.compile(r"[0-9a-f]{16,}", re.I),
    "mixed": re.compile(r"(?=\S*[0-9])(?=\S*[A-Za-z])[A-Za-z0-9_\-]{16,}"),
    "cased": re.compile(r"(?=\S*[a-z]\S*[A-Z])(?=\S*[A-Z]\S*[a-z])[A-Za-z0-9_\-]{16,}"),
    "capitals": re.compile(r"[A-Z0-9]{16,}"),
    "letters": re.compile(r"[a-z]{12,}"),
    "marked": re.compile(r"[A-Za-z]{2,6}[_-][A-Za-z0-9_\-]{12,}"),
    "date": re.compile(r"[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{2,4}"),
    "small": re.compile(r"[0-9]{1,3}(?: [0-9]{1,3})+"),
    "grouped": re.compile(r"\(?[0-9]{3,5}\)?[ -][0-9]{3,4}(?:[ -][0-9]{3,6})?"),
}
CUES = re.compile(r"token|secret|passw|key|card|visa|phone|tel|call|mobile|mail|contact|ip|host|server|addr", re.I)


def trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """Without quotes and punctuation around; a bracket that closes within the span stays."""
    while start < end and text[start] in LEAD and not (text[start] == "(" and ")" in text[start + 1 : end - 1]):
        start += 1
    while end > start and text[end - 1] in TRAIL:
        end -= 1
    return start, end


def features(text: str, start: int, end: int, before: str, tokens: int) -> list[str]:
    """Whole-span features of the candidate text[start:end]."""
    span = text[start:end]
    digits = sum("0" <= c <= "9" for c in span)
    plain = span.replace(" ", "").replace("-", "")
    out = [
        "bias",
        f"tokens{tokens}",
        f"digits{min(digits, 20) // 2}",
        f"share{digits * 4 // max(1, len(span))}",
        f"length{min(len(span), 48) // 6}",
        f"first{'d' if span[:1].isdigit() else 'a' if span[:1].isalpha() else span[:1]}",
    ]
    out += [
        f"is_{name}"
        for name, pattern in RELAXED.items()
        if (name != "address" or len(span) <= WIDEST) and pattern.fullmatch(span)
    ]
    if "@" in span:
        out.append(f"at{min(span.count('@'), 2)}")
    if plain.isdigit() and 16 <= len(plain) <= 19:
        out.append(f"luhn{luhn(plain)}" if plain.isascii() else "digits")
    cue = CUES.search(before)
    if cue:
        out.append(f"cue_{cue[0].lower()}")
    if before.rstrip().endswith(("=", ":", '="', "= \"")):
        out.append("assigned")
    if not digits and "@" not in span:
        out.append("no_trigger")
    if text[max(0, end) : end + 2].lstrip(" ")[:1].isdigit():
        out.append("goes_on")
    if start > 1 and text[start - 2 : start].rstrip(" ")[-1:].isdigit():
        out.append("went_on")
    return out


class SegmentField:
    """Weights of (feature, label), with training and decoding over candidate segments."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.weights = np.zeros((0, len(LABELS)))

    def segments(self, text: str, tokens, i: int, grow: bool = False):
        """(n, feature numbers, trimmed span) of the candidate segments of n tokens from token i."""
        before = text[max(0, tokens[i][0] - 24) : tokens[i][0]]
        for n in range(1, min(LONGEST, len(tokens) - i) + 1):
            start, end = trimmed(text, tokens[i][0], tokens[i + n - 1][1])
            if n > 1 and (start > tokens[i][1] or end <= tokens[i + n - 1][0] or end - start > WIDEST):
                continue
            names = features(text, start, end, before, n)
            if grow:
                found = [self.number.setdefault(x, len(self.number)) for x in names]
            else:
                found = [self.number[x] for x in names if x in self.number]
            yield n, found, (start, end)

    def label_scores(self, n: int, found) -> np.ndarray:
        """The scores of the labels; a segment of several tokens is of some kind."""
        own = self.weights[found].sum(axis=0)
        return own if n == 1 else np.concatenate(([-np.inf], own[1:]))

    def decode(self, text: str, tokens) -> list[tuple[str, int, int]]:
        """The best segmentation; of equal ones that with the shorter last segment.

        Segments are scored as the text is passed; what is kept of a token is the score of
        the best way to it and that way's last segment.
        """
        size = len(tokens)
        best = np.full(size + 1, -np.inf)
        length, kind = np.zeros(size + 1, np.int8), np.zeros(size + 1, np.int8)
        best[0] = 0
        for i in range(size):
            for n, found, _ in self.segments(text, tokens, i):
                own = self.label_scores(n, found)
                label = int(np.argmax(own))
                if best[i] + own[label] >= best[i + n]:
                    best[i + n], length[i + n], kind[i + n] = best[i] + own[label], n, label
        out, j = [], size
        while j:
            i = j - int(length[j])
            if kind[j]:
                out.append((LABELS[kind[j]], *trimmed(text, tokens[i][0], tokens[j - 1][1])))
            j = i
        return out[::-1]

    def fit(self, examples, epochs: int = 8, rate: float = 0.3, seed: int = 1) -> SegmentField:
        """Maximise the likelihood of the given segmentations by stochastic gradient steps."""
        prepared = []
        for text, tokens, spans in examples:
            cells = {
                (i, n): (found, span)
                for i in range(len(tokens))
                for n, found, span in self.segments(text, tokens, i, grow=True)
            }
            gold, at = [], 0
            by_span = {}
            for (i, n), (_, span) in cells.items():
                by_span.setdefault(span, (i, n))
            starts = {by_span[s[1:]][0]: (by_span[s[1:]][1], LABELS.index(s[0])) for s in spans if s[1:] in by_span}
            while at < len(tokens):
                n, label = starts.get(at, (1, 0))
                gold.append((at, n, label))
                at += n
            prepared.append((cells, gold, len(tokens)))
        self.weights = np.zeros((len(self.number), len(LABELS)))
        rng = random.Random(seed)
        for epoch in range(epochs):
            rng.shuffle(prepared)
            step = rate / (1 + epoch / 2)
            for cells, gold, size in prepared:
                scores = {(i, n): self.label_scores(n, found) for (i, n), (found, _) in cells.items()}
                ahead, behind = np.full(size + 1, -np.inf), np.full(size + 1, -np.inf)
                ahead[0] = behind[size] = 0
                total = {k: float(np.logaddexp.reduce(v)) for k, v in scores.items()}
                for j in range(1, size + 1):
                    ahead[j] = np.logaddexp.reduce(
                        [ahead[j - n] + total[j - n, n] for n in range(1, min(LONGEST, j) + 1) if (j - n, n) in total]
                    )
                for i in range(size - 1, -1, -1):
                    behind[i] = np.logaddexp.reduce(
                        [total[i, n] + behind[i + n] for n in range(1, min(LONGEST, size - i) + 1) if (i, n) in total]
                    )
                for (i, n), own in scores.items():
                    share = np.exp(ahead[i] + own + behind[i + n] - ahead[size])
                    if share.max() > 1e-4:
                        np.subtract.at(self.weights, cells[i, n][0], step * share)
                for i, n, label in gold:
                    np.add.at(self.weights, (cells[i, n][0], label), step)
            self.weights *= 1 - 0.002
        return self


# --- training ---------------------------------------------------------------------------


def generated(number: int = 1300, seed: int = 7):
    """(text, spans): sentences with one item each, in forms that the base patterns cover and others."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeilmnorstu") for _ in range(rng.randint(2, 8)))
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))

    def card():
        stem = rng.choice("3456") + digits(14)
        stem += next(str(d) for d in range(10) if luhn(stem + str(d)))
        return rng.choice([stem, " ".join(stem[i : i + 4] for i in range(0, 16, 4)), "-".join(stem[i : i + 4] for i in range(0, 16, 4))])

    mixed = lambda n, letters: "".join(rng.choice(letters) for _ in range(n))
    small, capital, number_ = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    make = [
        ("email", lambda: f"{word()}.{word()}{rng.randint(1, 99)}@{word()}.{rng.choice(['com', 'org', 'net'])}"),
        ("email", lambda: f"{word()}{rng.choice(['', '.' + word(), str(rng.randint(1, 9))])} (at) {word()} (dot) com"),
        ("email", lambda: f"{word()}{rng.choice(['', ' dot ' + word()])} at {word()} dot {rng.choice(['com', 'org', 'net'])}"),
        ("ip", lambda: ".".join(str(rng.randint(0, 255)) for _ in range(4))),
        ("card", card),
        ("phone", lambda: f"+{rng.randint(1, 99)} {digits(3)} {digits(3)} {digits(4)}"),
        ("phone", lambda: f"({digits(3)}) {digits(3)}-{digits(4)}"),
        ("phone", lambda: f"0{digits(2)} {digits(4)} {digits(4)}"),
        ("phone", lambda: f"{digits(3)}-{digits(3)}-{digits(4)}"),
        ("secret", lambda: mixed(rng.choice([32, 40, 64]), "0123456789abcdef")),
        ("secret", lambda: f"{rng.choice(['sk', 'pk', 'key'])}-{mixed(rng.randint(20, 40), small + capital)}"),
        ("secret", lambda: f"{rng.choice(['ghp', 'xoxb', 'tok'])}_{mixed(rng.randint(24, 36), small + capital + number_)}"),
        ("secret", lambda: f"A{mixed(3, capital)}{mixed(16, capital + number_)}"),
        ("", lambda: digits(rng.choice([1, 2, 3, 4, 5, 6, 8, 16]))),
        ("", lambda: f"{rng.randint(1, 31)}.{rng.randint(1, 12)}.{rng.randint(1990, 2030)}"),
        ("", lambda: f"{rng.randint(1990, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 31)}"),
        ("", lambda: f"{digits(1)}.{digits(2)}"),
        ("", lambda: f"{digits(3)},{digits(3)}"),
        ("", lambda: f"{word()}{digits(2)}"),
        ("", lambda: " ".join(digits(rng.randint(1, 2)) for _ in range(rng.randint(2, 9)))),
        ("", lambda: f"{rng.randint(1, 9)} {digits(3)} {digits(3)}"),
        ("", lambda: f"{rng.randint(10, 23)}:{rng.randint(10, 59)}"),
        ("", lambda: f"{rng.randint(1, 9)}.{rng.randint(0, 9)}.{rng.randint(0, 20)}"),
        ("", lambda: mixed(rng.randint(20, 30), small)),
        ("", lambda: f"{word()}-{word()}-{word()}-{word()}-{word()}"),
        ("", lambda: f"{word()} at {word()} {digits(1)}"),
    ]
    cues = {"secret": ['token = "', "secret: ", 'api_key = "', "key "], "phone": ["call ", "tel: ", "call "], "card": ["card "]}
    for i in range(number):
        kind, item = make[i % len(make)]
        lead = " ".join(word() for _ in range(rng.randint(1, 6)))
        tail = " ".join(word() for _ in range(rng.randint(1, 6)))
        cue = rng.choice(["", *cues.get(kind, [""])])
        body = item()
        text = f"{lead} {cue}{body}" + ('"' if cue.endswith('"') else rng.choice(["", ".", ","])) + f" {tail}."
        start = len(lead) + 1 + len(cue)
        yield text, [(kind, start, start + len(body))] if kind else []


def train(texts: list[str]) -> SegmentField:
    """Fit on generated sentences and on windows of ``texts`` with their base spans as labels.

    Windows without base spans and those of more than 40 tokens are not learnt from.
    """
    examples = []
    for text, spans in generated():
        for tokens in windows(text):
            examples.append((text, tokens, [s for s in spans if tokens[0][0] <= s[1] < tokens[-1][1]]))
    for text in texts:
        spans = base_spans(text)
        for tokens in windows(text):
            own = [s for s in spans if tokens[0][0] <= s[1] < tokens[-1][1]]
            if own and len(tokens) <= 40:
                examples.append((text, tokens, own))
    return SegmentField().fit(examples)


def sample_texts(docs: DataFrame, most: int = 100, longest: int = 5000) -> DataFrame:
    """``most`` distinct texts with an @ or a longer number, of at most ``longest`` characters, the first by a hash of the text."""
    own = docs.select("text").filter(F.length("text") <= longest).filter(F.col("text").rlike("@[a-z]|[0-9][0-9.]{6}"))
    own = own.withColumn("place", F.xxhash64("text"))
    # Hashes below the bound are far more than are wanted where texts are many, and all where they are few.
    number = own.agg(F.approx_count_distinct("place").alias("n")).first()["n"]
    bound = int(2**31 * min(1.0, (2 * most + 100) / max(number, 1)))
    drawn = own.filter(F.shiftrightunsigned("place", 33) <= bound).dropDuplicates(["place"])
    return drawn.orderBy("place").limit(most).select("text")


def fitted(docs: DataFrame) -> SegmentField:
    """The field trained on the texts of ``sample_texts``, inside a task."""
    return fit_in_task(sample_texts(docs), lambda rows: train(sorted(r["text"] for r in rows)))


# --- operator ---------------------------------------------------------------------------


def all_spans(text: str, field: SegmentField) -> tuple[list, list]:
    """(base spans, base and added spans), each by kind as listed, then start."""
    if not TRIGGER.search(text):
        return [], []
    base = base_spans(text)
    taken = np.array(sorted((s, e) for _, s, e in base), dtype=np.int64).reshape(-1, 2)
    reach = np.maximum.accumulate(taken[:, 1]) if len(taken) else taken[:, 1]
    added = []
    for tokens in windows(text):
        for kind, start, end in field.decode(text, tokens):
            i = int(np.searchsorted(taken[:, 0], end))
            if end > start and not (i and reach[i - 1] > start):
                added.append((kind, start, end))
    return base, sorted(base + added, key=lambda s: (KINDS.index(s[0]), s[1]))


def find_personal_data(docs: DataFrame, field: SegmentField | None = None) -> DataFrame:
    """Counts, digest and spans of personal data in every whole text.

    Null text counts as empty; a text without digits, @, an "at" as above and long keys has no spans. Spans of
    different base kinds may overlap; added spans overlap no base span. Repeated rows
    give the same spans, and the field depends on the rows only, not on their layout.
    """
    if field is None:
        field = fitted(docs)
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def find(batches):
        for batch in batches:
            counts, digests, lists = [[] for _ in BASE], [], []
            for text in batch.column(1):
                base, spans = all_spans(text.as_py() or "", shared.value)
                for column, kind in zip(counts, BASE, strict=True):
                    column.append(sum(s[0] == kind for s in base))
                digests.append(hashlib.sha256(listed(base).encode()).hexdigest())
                lists.append(listed(spans))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests), pa.array(lists)],
                [x.split()[0] for x in FOUND.split(", ")],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(find, FOUND)


def masked(text: str, spans) -> str:
    """``text`` with each span replaced by its kind in brackets; of overlapping spans the first stands."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def mask_personal_data(docs: DataFrame, field: SegmentField | None = None) -> DataFrame:
    """``docs`` with all spans masked in ``text`` and n_chars, if there, set to the new length."""
    if field is None:
        field = fitted(docs)
    shared = docs.sparkSession.sparkContext.broadcast(field)
    at = docs.columns.index("text")

    def mask(batches):
        for batch in batches:
            texts = []
            for text in batch.column(at):
                text = text.as_py()
                texts.append(text if not text else masked(text, all_spans(text, shared.value)[1]))
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    out = docs.mapInArrow(mask, docs.schema)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return out
