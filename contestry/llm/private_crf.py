"""Personal data: fixed patterns, and a linear-chain conditional random field.

The field labels the tokens around every digit or @ by word-shape features. It is
trained from a small labelled table and decoded by Viterbi over batches of token
sequences. What the patterns find stays; the field adds spans beside them.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contestry.llm import text as tx
from contestry.llm.columns import only, whole_text

KINDS = ("email", "ip", "card", "phone")
LABELS = ("other", *KINDS)
#: tokens on either side of one with a digit or @ that make up a sequence with it
CONTEXT = 3
#: longest sequence that is decoded beside others; longer ones go by pieces of so many tokens
SEQUENCE = 64
#: tokens on either side that the features of one look at
BESIDE = 2
ROUNDS, RATE, DECAY = 300, 0.1, 0.01

# ---- fixed patterns --------------------------------------------------------------------

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# a run of digits is tried from its first digit only, so long runs take linear time
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NO_DIGIT = re.compile("[^0-9]+")

Span = tuple[str, int, int]


def _emails(text: str) -> Iterator[Span]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            yield "email", start, end
        at = text.find("@", at + 1)


def _octets(address: str) -> bool:
    parts = [p.lstrip("0") or "0" for p in address.split(".")]
    return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str, digits: bool = True) -> list[Span]:
    """(kind, start, end) by start, then kind as listed; the patterns of the contract."""
    found = list(_emails(text))
    if digits:
        for m in _IP.finditer(text):
            if _octets(m[0]):
                found.append(("ip", m.start(), m.end()))
        for m in _CARD.finditer(text):
            number = _NO_DIGIT.sub("", m[0])
            if 14 <= len(number) <= 19 and _luhn(number):
                found.append(("card", m.start(), m.end()))
        for m in _PHONE.finditer(text):
            if 10 <= len(_NO_DIGIT.sub("", m[0])) <= 15:
                found.append(("phone", m.start(), m.end()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


# ---- the labelled table ----------------------------------------------------------------

#: texts with [kind:...] around what is personal; the names of kinds are those above
LABELLED = (
    "please write to [email:anna.lee@mail.example.org] before noon",
    "mail [email:j_doe+news@example.co.uk] or wait for an answer",
    "contact: [email:info99@shop.example.net]",
    "send it to [email:bob@example.com] and [email:eve.b@example.org] today",
    "her address is [email:k.o'neil@example.org] since may",
    "[email:team@example.dev] will reply",
    "the account [email:müller@beispiel.de] was closed",
    "call [phone:+1 (555) 201-4477] after six",
    "call [phone:(555) 201-4477] after six",
    "phone [phone:555-201-4477] or come by",
    "tel. [phone:+44 20 7946 0958] in the office",
    "tel: [phone:020 7946 0958] in the office",
    "my number is [phone:+49 151 2345 6789] now",
    "her mobile [phone:0151 2345 6789] is off",
    "fax [phone:+33 1 23 45 67 89] and phone [phone:01 23 45 67 89] work",
    "ring [phone:(020) 555-0199] at night",
    "reach us on [phone:555.201.4477] any day",
    "text [phone:+34 600 123 456] for help",
    "whatsapp [phone:+1-202-555-0143] please",
    "server [ip:10.20.30.40] is down",
    "from [ip:192.168.1.77] to [ip:8.8.4.4] in a second",
    "the host at [ip:172.16.254.1] answered",
    "login from [ip:203.0.113.9] failed twice",
    "open [ip:198.51.100.23] in the browser",
    "ip [ip:93.184.216.34] was blocked",
    "paid with [card:4111 1111 1111 1111] last week",
    "card [card:5500-0000-0000-0004] expires soon",
    "visa [card:4012888888881881] was charged",
    "the card number [card:3782 822463 10005] was read aloud",
    "use [card:6011000990139424] for the test",
    "charge [card:4242 4242 4242 4242] once",
    "in 2019 there were 12 of them on 3 days",
    "version 4.0 came after 3.11.2 and 2.0",
    "it cost 1,200.50 in 1998 and 35 now",
    "chapter 7, page 123, line 45",
    "the score was 21-14 at half time",
    "on 12.05.2021 or 2021-05-12 at 10:30",
    "section 3.2.1.4 of the manual",
    "build 1.2.3.4567 was released",
    "order 1234567890 was sent on 4 may",
    "the file has 1048576 bytes and 2048 lines",
    "token = 1eb9c654e721b4f812088970e66a6345",
    "id 550e8400-e29b-41d4-a716-446655440000 is new",
    "about 100 000 people and 3 000 cars",
    "room 5, floor 2, block 7b",
    "licensed under cc by 4.0 since 2013",
    "between 1939 and 1945 about 60 000 000 died",
    "call it a day at 5 or 6",
    "the phone has 4 buttons and 128 gb",
    "follow @someone or @another99 for news",
    "meet @ 8 pm or @ 9",
    "x = 3.14159 and y = 2.71828",
    "isbn 978-3-16-148410-0 was printed in 1999",
    "it weighs 12-15 kg and costs 99 $",
    "see [12] and [13, 14] in the list",
    "a b2b shop with 24/7 service",
    "the 90s and the 2000s were fine",
    "round 1 2 3 4 5 6 7 8 9 10 over",
    "the series 10 20 30 40 50 60 goes on",
)
_MARK = re.compile(r"\[(email|ip|card|phone):(.*?)\]")


def _unmarked(marked: str) -> tuple[str, list[Span]]:
    text, spans, at = "", [], 0
    for m in _MARK.finditer(marked):
        text += marked[at : m.start()]
        spans.append((m[1], len(text), len(text) + len(m[2])))
        text += m[2]
        at = m.end()
    return text + marked[at:], spans


# ---- features --------------------------------------------------------------------------

_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_SEED = re.compile(r"[0-9@]")
_EDGE = "\"'`*#$%&!?,;:<>{}[]|="
_CUES = frozenset(
    "mail e-mail email write address contact call phone tel tel. fax mobile number ring reach text whatsapp "
    "server host ip from login open card visa paid charge version chapter page section build order id isbn".split()
)


def shape(word: str) -> str:
    """X, x and d for letters and digits, with runs as their length up to 5."""
    out, last, n = [], "", 0
    for c in word + "\0":
        kind = "d" if "0" <= c <= "9" else "x" if c.islower() else "X" if c.isalpha() else c
        if kind == last:
            n += 1
            continue
        if last:
            out.append(last if n == 1 else f"{last}{min(n, 5)}")
        last, n = kind, 1
    return "".join(out)


@lru_cache(100_000)
def _word_features(word: str) -> tuple[str, ...]:
    digits = sum("0" <= c <= "9" for c in word)
    low = word.lower().strip(_EDGE)
    signs = "".join(sorted({c for c in word if not c.isalnum()}))
    return (
        f"s={shape(word)}",
        f"k={re.sub('[0-9]', '', shape(word))}",
        f"n={min(digits, 20)}",
        f"p={signs}",
        f"d={word.count('.')}",
        f"all={digits == len(word)}",
        f"c={low if low in _CUES else ''}",
    )


def features(words: list[str]) -> list[list[str]]:
    """Of each token: its own features, shapes beside it and cue words before it."""
    own = [_word_features(w) for w in words]
    out = []
    for i, f in enumerate(own):
        more = ["b", *f]
        for j in (-2, -1, 1, 2):
            at = i + j
            beside = own[at] if 0 <= at < len(own) else ("s=^",) * 7
            more += [f"{j}{beside[0]}", f"{j}{beside[2]}"]
            if j < 0:
                more.append(f"{j}{beside[6]}")
        out.append(more)
    return out


def sequences(text: str) -> Iterator[list[tuple[int, int]]]:
    """Token places around each digit or @; any other token is none of the kinds."""
    held: list[tuple[int, int]] = []
    before: list[tuple[int, int]] = []
    left = 0
    for m in _TOKEN.finditer(text):
        place = m.span()
        if _SEED.search(text, *place):
            held += before
            before = []
            held.append(place)
            left = CONTEXT
        elif left:
            held.append(place)
            left -= 1
        else:
            before = [*before[1 - CONTEXT :], place] if CONTEXT > 1 else [place]
            if held:
                yield held
                held = []
    if held:
        yield held


class Field:
    """A linear-chain conditional random field over the labels."""

    def __init__(self, index: dict[str, int], emit: np.ndarray, step: np.ndarray) -> None:
        self.index, self.emit, self.step = index, emit, step

    def _scores(self, batch: list[list[list[str]]]) -> tuple[np.ndarray, np.ndarray]:
        """Label scores, padded, and lengths of the sequences."""
        lengths = np.array([len(s) for s in batch])
        scores = np.zeros((len(batch), lengths.max(), len(LABELS)))
        rows, columns, ids = [], [], []
        for i, sequence in enumerate(batch):
            for t, names in enumerate(sequence):
                own = [self.index[n] for n in names if n in self.index]
                rows += [i] * len(own)
                columns += [t] * len(own)
                ids += own
        np.add.at(scores, (rows, columns), self.emit[ids])
        return scores, lengths

    def decode(self, batch: list[list[list[str]]]) -> list[np.ndarray]:
        """The best labels of each sequence, by Viterbi over all sequences at once."""
        scores, lengths = self._scores(batch)
        n, steps, labels = scores.shape
        back = np.zeros((n, steps, labels), np.int8)
        best = scores[:, 0].copy()
        for t in range(1, steps):
            paths = best[:, :, None] + self.step
            back[:, t] = paths.argmax(1)
            on = (t < lengths)[:, None]
            best = np.where(on, paths.max(1) + scores[:, t], best)
            back[:, t] = np.where(on, back[:, t], np.arange(labels))
        path = np.zeros((n, steps), np.int8)
        path[:, -1] = best.argmax(1)
        for t in range(steps - 1, 0, -1):
            path[:, t - 1] = back[np.arange(n), t, path[:, t]]
        return [p[:k] for p, k in zip(path, lengths)]

    def decode_long(self, words: list[str]) -> np.ndarray:
        """The best labels of one sequence of any length, the same as ``decode`` gives.

        Features are made piece by piece; the scores of the paths, and the tokens
        beside, go over the cuts.
        """
        back = np.zeros((len(words), len(LABELS)), np.int8)
        best: np.ndarray | None = None
        for a in range(0, len(words), SEQUENCE):
            left = max(a - BESIDE, 0)
            names = features(words[left : a + SEQUENCE + BESIDE])[a - left :][:SEQUENCE]
            for t, score in enumerate(self._scores([names])[0][0], a):
                if best is None:
                    best = score
                    continue
                paths = best[:, None] + self.step
                back[t] = paths.argmax(0)
                best = paths.max(0) + score
        path = np.zeros(len(words), np.int8)
        path[-1] = best.argmax()
        for t in range(len(words) - 1, 0, -1):
            path[t - 1] = back[t, path[t]]
        return path


def _log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis, keepdims=True))).squeeze(axis)


def train(
    labelled: Iterable[str] = LABELLED, rounds: int = ROUNDS, rate: float = RATE, decay: float = DECAY
) -> Field:
    """Maximum likelihood with decay, by gradient steps over the whole small table."""
    batch, gold = [], []
    for marked in labelled:
        text, spans = _unmarked(marked)
        for places in sequences(text):
            batch.append(features([text[a:b] for a, b in places]))
            gold.append([_label(a, b, spans) for a, b in places])
    index = {n: i for i, n in enumerate(sorted({n for s in batch for names in s for n in names}))}
    field = Field(index, np.zeros((len(index), len(LABELS))), np.zeros((len(LABELS),) * 2))
    _, lengths = field._scores(batch)
    n, steps = len(batch), int(lengths.max())
    at = [(i, t, index[f]) for i, s in enumerate(batch) for t, names in enumerate(s) for f in names]
    rows, columns, ids = (np.array(x) for x in zip(*at))
    real = np.arange(steps) < lengths[:, None]
    truth = np.zeros((n, steps, len(LABELS)))
    pairs = np.zeros((len(LABELS),) * 2)
    for i, labels in enumerate(gold):
        truth[i, np.arange(len(labels)), labels] = 1
        np.add.at(pairs, (labels[:-1], labels[1:]), 1)
    moments = [[np.zeros_like(w), np.zeros_like(w)] for w in (field.emit, field.step)]
    for k in range(1, rounds + 1):
        scores, _ = field._scores(batch)
        forward, backward = scores.copy(), np.zeros_like(scores)
        for t in range(1, steps):
            forward[:, t] = _log_sum(forward[:, t - 1, :, None] + field.step, 1) + scores[:, t]
        for t in range(steps - 2, -1, -1):
            ahead = _log_sum(field.step + (scores[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(real[:, t + 1, None], ahead, 0)
        total = _log_sum(forward[np.arange(n), lengths - 1], 1)
        expected = np.exp(np.where(real[..., None], forward + backward - total[:, None, None], -np.inf))
        moves = np.zeros_like(field.step)
        for t in range(steps - 1):
            joint = forward[:, t, :, None] + field.step + (scores[:, t + 1] + backward[:, t + 1])[:, None, :]
            moves += np.exp(joint - total[:, None, None])[real[:, t + 1]].sum(0)
        slope = np.zeros_like(field.emit)
        np.add.at(slope, ids, (truth - expected)[rows, columns])
        for w, g, m in ((field.emit, slope, moments[0]), (field.step, pairs - moves, moments[1])):
            g = g - decay * w
            m[0] = 0.9 * m[0] + 0.1 * g
            m[1] = 0.999 * m[1] + 0.001 * g * g
            w += rate * (m[0] / (1 - 0.9**k)) / (np.sqrt(m[1] / (1 - 0.999**k)) + 1e-8)
    return field


def _label(a: int, b: int, spans: list[Span]) -> int:
    return next((LABELS.index(k) for k, s, e in spans if a < e and s < b), 0)


#: digits that a span of a kind has to hold, beside what the field says
_DIGITS = {"ip": (4, 12), "card": (14, 19), "phone": (7, 15)}


def added_spans(texts: list[str], base: list[list[Span]], field: Field) -> list[list[Span]]:
    """What the field finds beside the base spans of each text.

    Neighbouring tokens of a label are one span, without the marks around it. A
    span that meets a base span, or can't be of its kind, is dropped.
    """
    batch, where = [], []
    out: list[list[Span]] = [[] for _ in texts]

    def add(i: int, places: list[tuple[int, int]], path: np.ndarray) -> None:
        for span in _runs(texts[i], places, path):
            if all(span[2] <= s or e <= span[1] for _, s, e in base[i]):
                out[i].append(span)

    for i, text in enumerate(texts):
        for places in sequences(text):
            words = [text[a:b] for a, b in places]
            if len(words) > SEQUENCE:
                add(i, places, field.decode_long(words))
                continue
            batch.append(features(words))
            where.append((i, places))
    order = sorted(range(len(batch)), key=lambda j: len(batch[j]))
    for a in range(0, len(order), 512):
        some = order[a : a + 512]
        for j, path in zip(some, field.decode([batch[j] for j in some])):
            add(*where[j], path)
    return [sorted(s, key=lambda x: (x[1], KINDS.index(x[0]))) for s in out]


def _valid(kind: str, found: str) -> bool:
    """What holds for anything of a kind; the field knows shapes only."""
    if kind == "email":
        return "@" in found[1:-1]
    if kind == "ip":
        return set(found) <= set("0123456789.") and _octets(found)
    return kind != "card" or _luhn(_NO_DIGIT.sub("", found))


def _runs(text: str, places: list[tuple[int, int]], path: np.ndarray) -> Iterator[Span]:
    t = 0
    while t < len(path):
        end = t + 1
        while end < len(path) and path[end] == path[t]:
            end += 1
        if path[t]:
            kind, a, b = LABELS[path[t]], places[t][0], places[end - 1][1]
            while a < b and text[a] in _EDGE + "(" and not (text[a] == "(" and ")" in text[a:b]):
                a += 1
            while a < b and text[b - 1] in _EDGE + ".)-":
                b -= 1
            n = sum("0" <= c <= "9" for c in text[a:b])
            least, most = _DIGITS.get(kind, (0, 1 << 30))
            if a < b and least <= n <= most and _valid(kind, text[a:b]):
                yield kind, a, b
        t = end


# ---- over documents --------------------------------------------------------------------

_SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
_HAS_DIGIT = np.zeros(256, bool)
_HAS_DIGIT[48:58] = True
_HAS_SEED = _HAS_DIGIT.copy()
_HAS_SEED[64] = True


def _rows_with(table: np.ndarray, data: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(table[data])))
    return total[cuts[1:]] > total[cuts[:-1]]


def private_spans(docs: DataFrame, labelled: Iterable[str] = LABELLED) -> DataFrame:
    """(doc_id, base, spans) of every row, places in code points, ends exclusive.

    ``base`` are the matches of the fixed patterns, ``spans`` these and what the
    field adds. Null and empty texts have none. Rows are looked at one by one, so
    repeated ids and an empty table need no care.
    """
    field = docs.sparkSession.sparkContext.broadcast(train(labelled))  # as small as the table

    def find(batches):
        for batch in batches:
            column = batch.column("text")
            data, offsets = tx.utf8(column)
            base: list[list[Span]] = []
            spans: list[list[Span]] = []
            for a, b in tx.runs(offsets):
                part, cuts = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                digits, seeds = _rows_with(_HAS_DIGIT, part, cuts), _rows_with(_HAS_SEED, part, cuts)
                at = np.flatnonzero(seeds)
                texts = column.slice(a, b - a).take(pa.array(at)).to_pylist()
                found = [base_spans(t, d) for t, d in zip(texts, digits[at])]
                added = added_spans(texts, found, field.value)
                own: list[list[Span]] = [[] for _ in range(b - a)]
                every: list[list[Span]] = [[] for _ in range(b - a)]
                for i, f, x in zip(at.tolist(), found, added):
                    own[i] = f
                    every[i] = sorted(f + x, key=lambda s: (s[1], KINDS.index(s[0])))
                base += own
                spans += every
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            lists = [pa.array([[dict(zip(("kind", "start", "end"), s)) for s in row] for row in x], kind) for x in (base, spans)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *lists], names=["doc_id", "base", "spans"])

    rows = only(docs, doc_id="doc_id", text="text").select("doc_id", whole_text("text").alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(find, f"doc_id {kind}, base {_SPANS}, spans {_SPANS}")


def private_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every row."""
    listed = lambda c: F.array_join(
        F.transform(
            c, lambda s: F.concat(s["kind"], F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))
        ),
        ",",
    )
    counts = [
        F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}") for k in KINDS
    ]
    return private_spans(docs).select(
        "doc_id", *counts, F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans")
    )
