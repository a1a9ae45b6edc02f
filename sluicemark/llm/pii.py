"""Personal data: base patterns, and boosted trees over wider candidates.

The base spans of a kind are the leftmost non-overlapping matches of its pattern that pass its check.  Generators
with high recall propose further spans (phones without a plus or without any separator, cards of other lengths, addresses with ``(at)`` or spelled out,
version 6 addresses, compressed ones too ...), which may overlap.  Gradient-boosted trees rate a candidate by its format and the words around
it; they are trained on the small table below.  A kind's threshold is calibrated on scores of rows that the
scoring trees haven't seen, as the lowest one that keeps the asked precision.  Candidates above it that touch no base span
are added, the best first where they overlap.

Documents are independent, so the work is one map without a shuffle.  Patterns are written so that their time is
linear in the text, whatever it holds, and overlaps are found by bisection; a very long text is one task's work.  Null text is empty and has no spans.  Null ids are carried along.
Repeated rows are searched alike.  An empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.98
ROUNDS = 60
RATE = 0.2
DEPTH = 3
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A match from inside a run of digits exists only if one from its start does.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

Span = tuple[str, int, int]


def _emails(text: str) -> Iterator[Span]:
    at, last = text.find("@"), 0
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at) if start < at else None
        if match:
            last = match.end()
            yield "email", start, last
        else:
            last = max(last, at + 1)  # no later address starts before this sign
        at = text.find("@", max(at + 1, last))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    found = list(_emails(text)) if "@" in text else []
    if any(d in text for d in "0123456789"):
        if "." in text:
            found += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
        found += [("card", *m.span()) for m in _CARD.finditer(text) if 14 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
        if "+" in text:
            found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return in_order(found)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


# Wider generators: kind, what a text must hold to be searched, pattern.  None starts inside a run that it could have started before, so their time
# stays linear, and none has a longest length but for digits.
_NAME, _LABEL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++", r"[A-Za-z0-9-]++"
GENERATORS = (
    ("email", ")]", re.compile(rf"{_NAME} ?[(\[] ?at ?[)\]] ?{_LABEL}(?: ?(?:\.|[(\[] ?dot ?[)\]]) ?{_LABEL})++", re.I)),
    ("email", (" at ", " AT ", " At "), re.compile(rf"{_NAME} at {_LABEL}(?: dot {_LABEL})++", re.I)),
    ("email", ("@",), re.compile(r"(?<=[A-Za-z0-9._%+-])@(?:localhost|\[[0-9.]{7,15}\])")),
    ("ip", (":",), re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}+:){4,7}+:?[0-9A-Fa-f]{1,4}+(?![0-9A-Fa-f:])")),
    ("ip", ("::",), re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{1,4}+(?::[0-9A-Fa-f]{1,4}+)*+::(?:[0-9A-Fa-f]{1,4}+(?::[0-9A-Fa-f]{1,4}+)*+)?|::[0-9A-Fa-f]{1,4}+(?::[0-9A-Fa-f]{1,4}+)*+)(?![\w:])")),
    ("card", "0123456789", re.compile(r"(?<![0-9])[0-9]{4}+(?:[ .-][0-9]{4,6}+){2,3}[ .-]?[0-9]{0,4}+(?![0-9])")),
    ("phone", "0123456789", re.compile(r"(?<![0-9+])\(?[0-9]{2,5}+\)?(?:[ ./-]{1,2}[0-9]{2,5}+){1,5}(?![0-9])")),
    ("phone", "0123456789", re.compile(r"(?<![\w.,:/+-])[0-9]{7,15}+(?![\w/-]|[.,:][0-9])")),
)
WORDS = {
    "email": re.compile(r"\b(?:e-?mail|mail|contact|write|reach|schreib\w*|correo|courriel|kontakt)\b", re.I),
    "ip": re.compile(r"\b(?:ip|host|server|address|from|login|client|peer|gateway|adresse)\b", re.I),
    "card": re.compile(r"\b(?:card|credit|visa|mastercard|amex|paid|payment|debit|cvv|karte|tarjeta|carte)\b", re.I),
    "phone": re.compile(r"\b(?:phone|tel|telephone|call|mobile|cell|fax|whatsapp|sms|ring|telefon|tel[eé]fono|t[eé]l[eé]phone|anruf\w*|llam\w*)\b", re.I),
}
AGAINST = re.compile(
    r"\b(?:version|v|order|invoice|isbn|issn|serial|no|nr|number|page|pages|date|born|year|room|item|ref|id|part|build|section|chapter|price|score|figure|table|model|sku|since|between|on|at|mac)\b", re.I
)
_WINDOW = 24

# Fixed training table: texts in which <kind:...> marks what is personal; every other candidate in them is not.
LABELLED = """
Call me at <phone:(415) 555-0132> tomorrow
my phone is <phone:415-555-0187>, ring any time
Tel. <phone:030 901820> or fax <phone:030 901821>
mobile: <phone:0171 555 4321>
Telefon <phone:089/636-48018> am Abend
llame al teléfono <phone:91 555 12 34>
tél <phone:01 55 52 12 99> le matin
WhatsApp <phone:617 555 0148> please
cell <phone:(212) 555 0199> after six
you can phone <phone:020 7946 0958> for help
sms to <phone:07700 900 123> only
call the office on <phone:555-0101> today
order 415-555-0132 was shipped
invoice no 030-90182 is due
between 1998-2004 and 2010-2015
on 2024-05-17 the rain came
born 12.03.1981 in the town
ISBN 978-3-16-148410 of the book
pages 112-118 and 220-231
score 21-17 21-19 in two sets
version 10.15.7 of the build
serial 4411-2290-18 on the back
room 12-204 in the wing
price 12.50 and 13.75 each
part 4002-118-22 is out of stock
ref 2020/11/30 and 17/2021
the ratio 10/12 and 14/16 was found
chapter 3.14.15 of the book
item 55-10-20 of the table
the numbers 12 34 56 78 came up
rows 10 20 30 40 are sorted
in 1914 18 and 1939 45 there was war
my card is <card:4111-1111-1111-1112> and valid
credit card <card:3782 822463 10006> of the guest
paid by visa <card:4000.0012.3456.7899> today
debit card <card:5100 0000 1111 222> was charged
tarjeta <card:4539 1488 0343 6460> del cliente
mastercard <card:5500-0055-5555-5558> expires soon
serial 4411-2290-1187-0034 on the back
order 2024-0517-2213-0001 was shipped
part 1000-2000-3000-4000 of the list
id 5566-7788-9900-1122 in the log
sku 4002.1187.2230.9911 is new
figure 1200 2400 3600 4800 in the table
the samples 1000 2000 3000 4000 were drawn
build 2023.1104.1200.0001 is out
the server at <ip:2001:db8:0:1:1:1:1:1> answered
login from <ip:fe80:0:0:0:202:b3ff:fe1e:8329> failed
client ip <ip:2001:db8:85a3:8d3:1319:8a2e:370:7348> was seen
host <ip:2001:db8:1:2:3:4:5:6> is down
mac 00:1b:44:11:3a:b7 of the card
mac 00:25:96:12:34:56 in the list
the time 12:30:45:10:22 was set
ratio 1:2:3:4:5:6 in the mix
id 10:20:30:40:50 of the item
serial aa:bb:cc:dd:ee:ff on the back
write to <email:jane.doe (at) example (dot) com> now
mail <email:sales[at]example.org> for it
contact <email:info (at) example.net> today
e-mail <email:max.muster(at)example.de> bitte
reach <email:ann [at] example [dot] org> there
write to <email:jane at example dot com> about it
mail <email:bob.lee AT mail DOT example DOT org> today
e-mail <email:joe(At)example.com> please
contact <email:anna at example dot de> for more
reach <email:m.weber(AT)example(DOT)net> there
email me: <email:kim at example dot co dot uk> thanks
schreibt an <email:tom at example dot at> bitte
correo <email:luis at ejemplo dot es> por favor
we sat at home dot that was all
meet at noon dot and bring food
the cat at rest dot the dog too
look at line dot two of the page
call <phone:4155550132> tomorrow
tel <phone:01715554321> after six
my mobile is <phone:07700900123> now
phone <phone:6175550148> for help
Telefon <phone:08963648018> am Abend
llame al <phone:915551234> por la tarde
fax <phone:2125550199> only
whatsapp <phone:447700900456> any time
order 4155550132 was shipped
invoice 2024051722 is due
id 1187003422 in the log
isbn 9783161484100 of the book
serial 44112290187 on the back
ref 20240517 and 20240611
the epoch 1700000000 had passed
about 7500000 people live there
number 12345678 on the list
part 40021187223 is out of stock
the sum of 12500000 was found
item 9911002233 of the table
host <ip:fe80::1> is up
login from <ip:2001:db8::8a2e:370:7334> failed
the server <ip:2001:db8::1> answered
gateway <ip:fe80::202:b3ff:fe1e:8329> is down
client <ip:2001:db8:85a3::7334> was seen
from <ip:::1> on this host
peer <ip:2001:db8:1::> joined
the scope ab::cd of the code
class cafe::babe has a field
a::b in the grammar
the name de::ad is taken
meet (at) noon.sharp or later
we met[at]home.again yesterday
look (at) this.one there
""".strip().splitlines()


def candidates(text: str) -> list[Span]:
    found = []
    for kind, needs, pattern in GENERATORS:
        if any(n in text for n in needs):
            for m in pattern.finditer(text):
                start = m.start()
                if m[0][0] == "@":
                    while start and text[start - 1] in _LOCAL:
                        start -= 1
                found.append((kind, start, m.end()))
    return found


def features(text: str, span: Span) -> list[float]:
    kind, start, end = span
    inner, before, after = text[start:end], text[max(0, start - _WINDOW) : start], text[end : end + _WINDOW]
    digits = _digits(inner)
    groups = [len(g) for g in re.findall(r"[0-9]+", inner)]
    first = int(inner[: groups[0]]) if groups and inner[0].isdigit() and groups[0] < 6 else 0
    return [
        KINDS.index(kind), len(inner), len(digits), len(groups), max(groups, default=0), min(groups, default=0), luhn(digits) if digits else 0,
        inner.count("-"), inner.count("."), inner.count("/"), inner.count(" "), "(" in inner, 1900 <= first < 2100, digits.startswith("0"),
        bool(WORDS[kind].search(before)), bool(WORDS[kind].search(after)), bool(AGAINST.search(before)), before[-1:].isalnum(), after[:1].isalnum(),
        len(set(digits)), "dot" in inner.lower(), max((len(g) for g in re.findall(r"[0-9A-Fa-f]+", inner)), default=0),
    ]


def labelled_candidates(lines: list[str]) -> tuple[list[tuple[str, Span]], np.ndarray]:
    """Candidates of the marked texts; one is personal if it meets a mark of its kind over more than half of both."""
    rows, kept = [], []
    for line in lines:
        text, marks = "", []
        for part in re.split(r"(<[a-z]+:[^>]*>)", line):
            if part.startswith("<"):
                kind, _, inner = part[1:-1].partition(":")
                marks.append((kind, len(text), len(text) + len(inner)))
                text += inner
            else:
                text += part
        for span in candidates(text):
            shared = [min(span[2], e) - max(span[1], s) for k, s, e in marks if k == span[0]]
            longest = [max(span[2] - span[1], e - s) for k, s, e in marks if k == span[0]]
            rows.append((text, span))
            kept.append(any(2 * a > b for a, b in zip(shared, longest, strict=True)))
    return rows, np.array(kept, dtype=np.float64)


def _grow(x: np.ndarray, slope: np.ndarray, curve: np.ndarray, depth: int) -> tuple:
    """Regression tree on gradients: (feature, cut, rows up to it, others), or a leaf's step."""
    step = (slope.sum() / (curve.sum() + 1.0),)
    if depth == 0:
        return step
    best, gain = None, slope.sum() ** 2 / (curve.sum() + 1.0) + 1e-6
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for cut in (values[:-1] + values[1:]) / 2:
            left = x[:, f] <= cut
            if min(curve[left].sum(), curve[~left].sum()) < 0.3:
                continue
            found = sum(slope[s].sum() ** 2 / (curve[s].sum() + 1.0) for s in (left, ~left))
            if found > gain:
                best, gain = (f, float(cut), left), found
    if best is None:
        return step
    f, cut, left = best
    return (f, cut, _grow(x[left], slope[left], curve[left], depth - 1), _grow(x[~left], slope[~left], curve[~left], depth - 1))


def _step(tree: tuple, row: list[float]) -> float:
    while len(tree) > 1:
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree[0]


def boost(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, rate: float = RATE, depth: int = DEPTH) -> list[tuple]:
    """Trees whose steps add up to the log-odds of being personal."""
    total, trees = np.zeros(len(y)), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-total))
        tree = _grow(x, y - p, p * (1 - p), depth)
        total += rate * np.array([_step(tree, row) for row in x.tolist()])
        trees.append(tree)
    return trees


def rate_row(trees: list[tuple], row: list[float], rate: float = RATE) -> float:
    return float(1 / (1 + np.exp(-rate * sum(_step(t, row) for t in trees))))


def train(lines: list[str] = LABELLED, precision: float = PRECISION, folds: int = 4) -> tuple[list[tuple], dict[str, float]]:
    """The trees, and for each kind the threshold; a kind that can't keep the precision adds nothing."""
    rows, y = labelled_candidates(lines)
    x = np.array([features(t, s) for t, s in rows], dtype=np.float64)
    fold = np.arange(len(y)) % folds
    unseen = np.zeros(len(y))
    for f in range(folds):
        trees = boost(x[fold != f], y[fold != f])
        unseen[fold == f] = [rate_row(trees, row) for row in x[fold == f].tolist()]
    thresholds = {}
    for i, kind in enumerate(KINDS):
        own = x[:, 0] == i
        cuts = [c for c in np.unique(unseen[own]) if y[own & (unseen >= c)].mean() >= precision]
        thresholds[kind] = max(0.5, float(cuts[0])) if cuts else 2.0
    return boost(x, y), thresholds


def all_spans(text: str, base: list[Span], model: tuple[list[tuple], dict[str, float]]) -> list[Span]:
    trees, thresholds = model
    rated = []
    for span in candidates(text):
        score = rate_row(trees, features(text, span))
        if score >= thresholds[span[0]]:
            rated.append((-score, span))
    if not rated:
        return base
    taken, more = _Taken((s, e) for _, s, e in base), []
    for _, span in sorted(rated):
        if taken.add(*span[1:]):
            more.append(span)
    return in_order([*base, *more])


class _Taken:
    """Places that are taken, as disjoint ranges in order."""

    def __init__(self, ranges: Iterable[tuple[int, int]]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, end in sorted(ranges):
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def add(self, start: int, end: int) -> bool:
        """Take the range, if nothing of it is taken."""
        at = bisect_right(self.starts, start)
        if (at and self.ends[at - 1] > start) or (at < len(self.starts) and self.starts[at] < end):
            return False
        self.starts.insert(at, start)
        self.ends.insert(at, end)
        return True


def written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lines: list[str] = LABELLED) -> DataFrame:
    """(doc_id, base, spans) of every document, each written as kind:start:end, comma-joined, in code points."""
    model = train(lines)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, every = [], []
            for value in batch.column(1):
                words = value.as_py() or ""
                found = base_spans(words)
                base.append(written(found))
                every.append(written(all_spans(words, found, model)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, pa.string()), pa.array(every, pa.string())], names=["doc_id", "base", "spans"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, base string, spans string")


def count_of(spans: Column, kind: str) -> Column:
    """Number of spans of a kind in a written list."""
    return F.size(F.filter(F.split(spans, ","), lambda s: F.startswith(s, F.lit(kind + ":")))).cast("long")
