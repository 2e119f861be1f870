"""Personal data in texts: fixed patterns, and a semi-Markov conditional random field for what they miss.

The patterns find emails, IP addresses, cards and telephone numbers in their plain
forms. The random field reads the neighbourhood of digits, @ signs and spelled-out
addresses as tokens and scores whole spans of up to ``LONGEST`` tokens: how many
digits in which groups, which separators, whether Luhn's and the IBAN's check sums
hold, what stands before and after, which words lead to it. Dynamic programming
over segments chooses boundaries and kinds together, so that two numbers side by
side, a number behind a telephone, an address spelled with (at) and dot, national
numbers and IBANs are told apart. Spans of the patterns always stay; a predicted
one that touches them is left out.

Weights are trained on sentences that are made of windows of at most
``SAMPLE_DOCS`` texts of the corpus, chosen by hash, and of generated data and
look-alikes (versions, dates, orders, keys, numbers whose check sum fails). Long
texts are read whole and in linear time; only the windows are tokenised.
"""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds in the order of the results; the first four have fixed patterns.
KINDS = ["email", "ip", "card", "phone", "iban", "national_id"]
#: Documents whose windows training sees, windows of each, sentences trained on, and rounds over them.
SAMPLE_DOCS, WINDOWS, SENTENCES, ROUNDS = 300, 4, 400, 6
#: Tokens of the longest span, and characters read on each side of a digit or @.
LONGEST, AROUND = 24, 48
#: Tokens whose segments are scored at once.
BLOCK = 1 << 13

# Patterns of plain forms. Possessive, and bound to the start of a run, so that no text takes more than
# linear time; they match what the plain patterns match.
LOCAL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\Z")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        if place % 2:
            value = value * 2 - 9 * (value > 4)
        total += value
    return total % 10 == 0


def digits_of(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def plain_spans(text: str) -> list[tuple[int, int, int]]:
    """kind, start and end of what the fixed patterns find, by kind, then start."""
    found = []
    end = 0
    at = text.find("@")
    while at >= 0:
        local, domain = LOCAL.search(text[end:at]), DOMAIN.match(text, at + 1)
        if local and domain:
            found.append((0, end + local.start(), domain.end()))
            end = domain.end()
        else:
            end = at + 1
        at = text.find("@", end)
    for match in IP.finditer(text):
        parts = [part.lstrip("0") for part in match[0].split(".")]
        if all(len(part) < 4 and int(part or 0) < 256 for part in parts):
            found.append((1, match.start(), match.end()))
    for kind, pattern, least, most in ((2, CARD, 13, 19), (3, PHONE, 9, 15)):
        for match in pattern.finditer(text):
            digits = digits_of(match[0])
            if least <= len(digits) <= most and (kind == 3 or luhn(digits)):
                found.append((kind, match.start(), match.end()))
    return found


# ---------------------------------------------------------------- windows and tokens

NEAR = re.compile(r"[0-9]+|@|[(\[{<] ?at ?[)\]}>]|\bdot\b", re.I)
TOKEN = re.compile(r"[^\W_]+|.", re.S)
#: Token types; a mixed one has letters and digits.
BREAK, DIGITS, LETTERS, MIXED, PLUS, DOT, DASH, SPACE, OPEN, CLOSE, AT, COLON, SLASH, OTHER = range(14)
HAS_DIGIT = re.compile("[0-9]")
TYPE = {"+": PLUS, ".": DOT, "-": DASH, " ": SPACE, "\t": SPACE, "(": OPEN, "[": OPEN, "{": OPEN, "<": OPEN, ")": CLOSE,
        "]": CLOSE, "}": CLOSE, ">": CLOSE, "@": AT, ":": COLON, "/": SLASH}
# Words that lead to a number or an address, by what follows.
CUES = {
    1: "tel phone telephone telefon teléfono téléphone mobile cell call fax handy",
    2: "card visa mastercard amex credit karte tarjeta carte",
    3: "ip host server address",
    4: "ssn social security",
    5: "iban account konto cuenta compte",
    6: "mail email contact write",
    7: "order version invoice ref no id date page isbn token key release section price chapter vol",
}
CUE = {word: code for code, words in CUES.items() for word in words.split()}


def windows(text: str) -> list[tuple[int, int]]:
    """Parts of the text around digits, @ signs and spelled-out addresses; none begins or ends inside a word."""
    parts = []
    for match in NEAR.finditer(text):
        begin, end = max(match.start() - AROUND, 0), match.end() + AROUND
        if parts and begin <= parts[-1][1]:
            parts[-1][1] = end
        else:
            parts.append([begin, end])
    out = []
    for begin, end in parts:
        while begin and text[begin - 1].isalnum() and text[begin].isalnum() and begin > (out[-1][1] if out else 0):
            begin -= 1
        end = min(end, len(text))
        while end < len(text) and text[end - 1].isalnum() and text[end].isalnum():
            end += 1
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return [(begin, end) for begin, end in out]


class Sentence:
    """Tokens of many windows one after the other, with a break between them."""

    def __init__(self):
        self.types, self.words, self.starts, self.owners = [BREAK], [""], [-1], [-1]

    def add(self, text: str, begin: int, end: int, owner: int):
        for match in TOKEN.finditer(text, begin, end):
            word = match[0]
            if word[0].isalnum():
                kind = MIXED if HAS_DIGIT.search(word) else LETTERS
                kind = DIGITS if word.isascii() and word.isdigit() else kind
            else:
                kind = TYPE.get(word, OTHER)
            self.types.append(kind)
            self.words.append(word)
            self.starts.append(match.start())
            self.owners.append(owner)
        self.types.append(BREAK)
        self.words.append("")
        self.starts.append(-1)
        self.owners.append(-1)


# ---------------------------------------------------------------- features of whole spans

# Usual groups of digits of cards, telephones and national numbers.
GROUPS = ["16", "4 4 4 4", "4 6 5", "15", "3 3 4", "1 3 3 4", "3 4", "3 2 4", "9", "10", "11", "13", "2 2 2 2 2", "4 2 2", "2 2 4"]


def _group_code(pattern: str) -> int:
    code = 0
    for size in pattern.split():
        code = code * 32 + int(size)
    return code


CODES = np.sort(np.array([_group_code(p) for p in GROUPS], np.int64))
BOUNDS = {
    "digits": [1, 4, 7, 8, 9, 10, 11, 12, 13, 16, 17, 20],
    "groups": [1, 2, 3, 4, 5, 6, 9],
    "letters": [1, 3, 6, 11, 21],
    "dots": [1, 2, 3, 4, 5], "spelled": [1, 2, 3], "dashes": [1, 2, 3, 4, 5], "spaces": [1, 2, 3, 4, 5, 7],
    "colons": [1, 2, 3, 6, 8], "others": [1, 2], "slashes": [1, 2, 3],
}
#: Values of each feature, in the order in which features() gives them.
SIZES = [13, 8, 6, 6, 4, 6, 7, 6, 3, 4, 4, 3, 15, 15, 14, 14, 3, 2, len(CODES) + 1, 8, 3, 3, 2]
OFFSETS = np.concatenate([[0], np.cumsum(SIZES)[:-1]])


IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9])+\Z")


def _mod97(text: str) -> bool:
    text = re.sub("[^0-9A-Za-z]", "", text).upper()
    moved = text[4:] + text[:4]
    rest = 0
    for at in range(0, len(moved), 8):
        rest = int(str(rest) + "".join(str(int(c, 36)) for c in moved[at : at + 8])) % 97
    return rest == 1


class Spans:
    """Candidate spans of a sentence and the features of each.

    A candidate begins and ends with a digit, letter, plus or opening or closing
    mark, crosses no break, and holds a digit, an @ or a spelled-out one.
    """

    def __init__(self, sentence: Sentence, begin: int, end: int):
        """Candidates that start in [begin, end) of the sentence."""
        last = min(end + LONGEST, len(sentence.types))
        kinds = np.array(sentence.types[begin:last])
        words = sentence.words[begin:last]
        n = len(kinds)
        lower = [w.lower() for w in words]
        size = np.array([len(w) for w in words])
        digits, letters, mixed = kinds == DIGITS, kinds == LETTERS, kinds == MIXED
        in_mixed = np.zeros(n, np.int64)
        for k in np.flatnonzero(mixed).tolist():
            in_mixed[k] = len(digits_of(words[k]))
        spelled_dot = np.array([w == "dot" for w in lower])
        spelled_at = np.array([w == "at" for w in lower])
        boxed = np.zeros(n, bool)
        inner = np.flatnonzero(spelled_at)
        for k in inner.tolist():
            left, right = k - 1, k + 1
            left -= left >= 0 and kinds[left] == SPACE
            right += right < n and kinds[right] == SPACE
            boxed[k] = left >= 0 and right < n and kinds[left] == OPEN and kinds[right] == CLOSE
        before = lambda flags: np.concatenate([[0], np.cumsum(flags)])
        sums = {
            "digits": before(size * digits + in_mixed), "groups": before(digits), "letters": before(size * (letters | mixed) - in_mixed),
            "at": before(kinds == AT), "boxed": before(boxed), "spelled_at": before(spelled_at), "spelled": before(spelled_dot),
            "dots": before(kinds == DOT), "dashes": before(kinds == DASH), "spaces": before(kinds == SPACE),
            "colons": before(kinds == COLON), "others": before((kinds == OTHER) | (kinds == PLUS)),
            "slashes": before(kinds == SLASH), "open": before(kinds == OPEN), "close": before(kinds == CLOSE),
            "small": before(np.array([k == DIGITS and len(w) < 4 and int(w) < 256 for k, w in zip(kinds, words, strict=True)])),
            "hex": before(np.array([len(w) <= 4 and all(c in "0123456789abcdef" for c in w) for w in lower]) & (digits | letters | mixed)),
            "runs": before(digits | letters | mixed), "breaks": before(kinds == BREAK),
        }
        first, length = np.arange(min(end - begin, n)), np.arange(1, LONGEST + 1)
        start = np.repeat(first, LONGEST)
        stop = start + np.tile(length, len(first))
        keep = stop <= n
        starts = np.isin(kinds, [DIGITS, LETTERS, MIXED, PLUS, OPEN])
        ends = digits | letters | mixed
        start, stop = start[keep], stop[keep]
        keep = starts[start] & ends[stop - 1]
        start, stop = start[keep], stop[keep]
        span = {name: total[stop] - total[start] for name, total in sums.items()}
        keep = (span["breaks"] == 0) & (span["digits"] + span["at"] + span["boxed"] + span["spelled"] > 0)
        keep &= (span["digits"] >= 4) | (span["at"] + span["boxed"] + span["spelled"] + span["colons"] > 0)
        start, stop = start[keep], stop[keep]
        span = {name: count[keep] for name, count in span.items()}

        code = np.zeros(len(start), np.int64)
        for step in range(LONGEST):
            at = np.minimum(start + step, n - 1)
            here = (start + step < stop) & digits[at]
            code = np.where(here, np.minimum(code, 1 << 57) * 32 + np.minimum(size[at], 31), code)
        spot = np.minimum(np.searchsorted(CODES, code), len(CODES) - 1)
        pattern = np.where(CODES[spot] == code, spot + 1, 0)

        cues = np.zeros(n, np.int64)
        recent = [0, 0, 0]
        for k, word in enumerate(lower):
            cues[k] = next((c for c in reversed(recent) if c), 0)
            if kinds[k] == BREAK:
                recent = [0, 0, 0]
            elif kinds[k] == LETTERS:
                recent = [*recent[1:], CUE.get(word, 0)]

        text = lambda k: "".join(words[start[k] : stop[k]])
        luhns = np.zeros(len(start), np.int64)
        for k in np.flatnonzero((span["digits"] >= 13) & (span["digits"] <= 19) & (span["letters"] == 0)).tolist():
            luhns[k] = 1 if luhn(digits_of(text(k))) else 2
        ibans = np.zeros(len(start), np.int64)
        lead = mixed[start] & (span["digits"] + span["letters"] >= 15) & (span["digits"] + span["letters"] <= 34)
        for k in np.flatnonzero(lead).tolist():
            ibans[k] = 1 if IBAN.match(text(k)) and _mod97(text(k)) else 2

        bucket = lambda name: np.searchsorted(BOUNDS[name], span[name], side="right")
        at_kind = np.select(
            [span["at"] > 1, span["at"] == 1, span["boxed"] > 0, (span["spelled_at"] > 0) & (span["spelled"] > 0), span["spelled_at"] > 0],
            [2, 1, 3, 4, 5], 0,
        )
        parens = np.select([span["open"] != span["close"], span["open"] > 0], [2, 1], 0)
        left = np.where(start > 0, kinds[np.maximum(start - 1, 0)], BREAK)
        right = np.where(stop < n, kinds[np.minimum(stop, n - 1)], BREAK)
        opening = np.where(spelled_at | spelled_dot, 14, kinds)
        quad = np.where((span["groups"] == 4) & (span["small"] == 4) & (span["letters"] == 0), np.where(span["dots"] == 3, 2, 1), 0)
        six = np.where((span["hex"] == span["runs"]) & (span["colons"] > 1), 1, 0)
        domain = letters[stop - 1] & (size[stop - 1] >= 2) & (size[stop - 1] <= 6)
        domain &= (kinds[np.maximum(stop - 2, 0)] == DOT) | (spelled_dot[np.maximum(stop - 3, 0)])
        values = [
            bucket("digits"), bucket("groups"), bucket("letters"), at_kind, bucket("spelled"), bucket("dots"), bucket("spaces"),
            bucket("dashes"), np.minimum(bucket("others"), 2), bucket("slashes"), parens + (kinds[start] == OPEN), quad,
            opening[start], opening[stop - 1], left, right, luhns, six, pattern, cues[start], ibans,
            np.minimum(bucket("colons"), 2), domain.astype(np.int64),
        ]
        self.features = np.stack([v.astype(np.int64) + o for v, o in zip(values, OFFSETS, strict=True)], 1)
        self.start, self.stop = start + begin, stop + begin


# ---------------------------------------------------------------- the random field

N_LABELS = 1 + len(KINDS)  # 0 is a token outside every span


class Field:
    """Weights of features by kind, and of a kind after another."""

    def __init__(self):
        self.weights = np.zeros((sum(SIZES), len(KINDS)))
        self.follow = np.zeros((N_LABELS, N_LABELS))

    def scores(self, spans: Spans) -> np.ndarray:
        out = np.zeros((len(spans.start), len(KINDS)))
        for column in range(spans.features.shape[1]):
            out += self.weights[spans.features[:, column]]
        return out


def _stops(n: int, start: np.ndarray, stop: np.ndarray):
    """Places where spans begin or end, with 0 and n; spans by their numbers; and the tokens before each place.

    Tokens between two such places lie outside every span.
    """
    places = np.unique(np.concatenate([[0, n], start, stop]))
    return places, np.searchsorted(places, start), np.searchsorted(places, stop), np.diff(places, prepend=0)


def best_segments(field: Field, n: int, start: np.ndarray, stop: np.ndarray, scores: np.ndarray) -> list[tuple[int, int, int]]:
    """start, stop and kind of the spans of the best segmentation of n tokens; tokens outside score 0."""
    order = np.argsort(stop, kind="stable")
    start, stop, scores = start[order], stop[order], scores[order]
    places, begin, end, gaps = _stops(n, start, stop)
    bounds = np.searchsorted(end, np.arange(len(places) + 1)).tolist()
    follow, labels = field.follow.T, np.arange(N_LABELS)  # follow: by label, then the one before
    best = np.full((len(places), N_LABELS), -np.inf)
    best[0, 0] = 0
    came = np.zeros((len(places), N_LABELS), np.int64)  # the span that a label ends
    reach = np.full((len(places), N_LABELS), -np.inf)  # best score before a segment of a label that starts here
    last = np.zeros((len(places), N_LABELS), np.int64)  # and the label before it
    for t in range(len(places)):
        if t:
            best[t, 0] = reach[t - 1, 0] + (gaps[t] - 1) * follow[0, 0]
            low, high = bounds[t], bounds[t + 1]
            if low < high:
                found = reach[begin[low:high], 1:] + scores[low:high]
                came[t, 1:] = found.argmax(0) + low
                best[t, 1:] = found.max(0)
        ways = best[t] + follow
        last[t] = ways.argmax(1)
        reach[t] = ways[labels, last[t]]
    out, t, label = [], len(places) - 1, int(best[-1].argmax())
    while t:
        if label:
            k = came[t, label]
            out.append((int(start[k]), int(stop[k]), label - 1))
            t, label = int(begin[k]), int(last[begin[k], label])
        else:
            t -= 1
            label = int(last[t, 0])  # of several tokens outside, the first alone follows another label
    return out[::-1]


def gradient(field: Field, n: int, spans: Spans, gold: dict[tuple[int, int], int]):
    """Log likelihood of the gold spans, and its gradient by weights and by follow."""
    scores, follow = field.scores(spans), field.follow
    places, begin, end, gaps = _stops(n, spans.start, spans.stop)
    m = len(places)
    ending, starting = [[] for _ in range(m)], [[] for _ in range(m)]
    for k, (a, b) in enumerate(zip(begin.tolist(), end.tolist(), strict=True)):
        ending[b].append(k)
        starting[a].append(k)
    ahead, reach, behind, onward = (np.full((m, N_LABELS), -1e300) for _ in range(4))
    ahead[0, 0] = 0
    for t in range(m):
        if t:
            ahead[t, 0] = reach[t - 1, 0] + (gaps[t] - 1) * follow[0, 0]
            if ending[t]:
                ahead[t, 1:] = np.logaddexp.reduce(reach[begin[ending[t]], 1:] + scores[ending[t]], 0)
        reach[t] = np.logaddexp.reduce(ahead[t][:, None] + follow, 0)
    behind[-1] = 0
    for t in range(m - 2, -1, -1):
        onward[t, 0] = (gaps[t + 1] - 1) * follow[0, 0] + behind[t + 1, 0]
        if starting[t]:
            onward[t, 1:] = np.logaddexp.reduce(scores[starting[t]] + behind[end[starting[t]], 1:], 0)
        behind[t] = np.logaddexp.reduce(follow + onward[t], 1)
    total = behind[0, 0]
    share = np.exp(np.minimum(reach[begin, 1:] + scores + behind[end, 1:] - total, 0))
    steps = np.exp(np.minimum(ahead[:-1, :, None] + follow + onward[:-1, None, :] - total, 0)).sum(0)
    steps[0, 0] += ((gaps[1:] - 1) * np.exp(np.minimum(reach[:-1, 0] + onward[:-1, 0] - total, 0))).sum()

    hit = np.zeros_like(share)
    likely = -total
    path = np.zeros((N_LABELS, N_LABELS))
    where = {(int(a), int(b)): k for k, (a, b) in enumerate(zip(spans.start, spans.stop, strict=True))}
    t, label = 0, 0
    for (a, b), kind in sorted(gold.items()):
        for _ in range(t, a):
            path[label, 0] += 1
            label = 0
        hit[where[a, b], kind] = 1
        likely += scores[where[a, b], kind]
        path[label, kind + 1] += 1
        t, label = b, kind + 1
    for _ in range(t, n):
        path[label, 0] += 1
        label = 0
    likely += (path * follow).sum()
    change = hit - share
    some = np.abs(change).max(1, initial=0) > 1e-6
    rows = spans.features[some].T.ravel()
    parts = np.tile(change[some], (spans.features.shape[1], 1))
    by_weight = np.stack([np.bincount(rows, parts[:, k], len(field.weights)) for k in range(len(KINDS))], 1)
    return likely, by_weight, path - steps


# ---------------------------------------------------------------- training sentences


class Maker:
    """Generates personal data, look-alikes and sentences with both."""

    def __init__(self, seed: int, texts: list[str]):
        self.draw, self.texts = random.Random(seed), texts or ["one two three four five six"]

    def digits(self, n: int) -> str:
        return "".join(self.draw.choices("0123456789", k=n))

    def word(self, least=2, most=9) -> str:
        return "".join(self.draw.choices("abcdefghilmnoprstuv", k=self.draw.randint(least, most)))

    def card(self) -> str:
        size = self.draw.choices([16, 15, 13, 19], [8, 2, 1, 1])[0]
        body = self.draw.choice("3456") + self.digits(size - 2)
        whole = next(body + d for d in "0123456789" if luhn(body + d))
        return self.grouped(whole)

    def grouped(self, whole: str) -> str:
        separator = self.draw.choices(["", " ", "-", "."], [6, 3, 2, 1])[0]
        sizes = [4, 6, 5] if len(whole) == 15 else [4] * 5
        parts, at = [], 0
        for size in sizes:
            parts.append(whole[at : at + size])
            at += size
        return separator.join(p for p in parts if p)

    def phone(self) -> str:
        d = self.digits
        area, local = str(self.draw.randint(200, 999)), d(4)
        return self.draw.choice(
            [f"+{self.draw.randint(1, 99)} ({area}) 555-{local}", f"+1 {area} {d(3)} {local}", f"({area}) {d(3)}-{local}",
             f"{area}-{d(3)}-{local}", f"{area}.{d(3)}.{local}", f"+{self.draw.randint(30, 49)} {d(2)} {d(7)}", f"+{d(11)}"]
        )

    def email(self) -> str:
        user, host, last = self.word(), self.word(), self.draw.choice(["com", "org", "net", "de", "fr", "es"])
        user += self.draw.choice(["", "." + self.word(), "." + self.digits(2), self.digits(2)])
        host = self.draw.choice([host, f"mail{self.draw.randint(0, 9)}.example", f"{host}.{self.word(3, 5)}"])
        at, dot = self.draw.choices([("@", "."), (" (at) ", "."), ("[at]", "."), (" [at] ", " [dot] "), (" at ", " dot "), (" (at) ", " dot ")], [5, 1, 1, 1, 2, 1])[0]
        return f"{user}{at}{host.replace('.', dot)}{dot}{last}"

    def ip(self) -> str:
        if self.draw.random() < 0.75:
            return ".".join(str(self.draw.randint(0, 255)) for _ in range(4))
        groups = [f"{self.draw.randint(0, 65535):x}" for _ in range(8)]
        return ":".join(groups) if self.draw.random() < 0.6 else ":".join(groups[:3]) + "::" + ":".join(groups[-2:])

    def iban(self) -> str:
        country, size = self.draw.choice([("DE", 18), ("FR", 23), ("ES", 20), ("AT", 16), ("NL", 14)])
        body = self.digits(size)
        whole = next(f"{country}{k:02}{body}" for k in range(2, 99) if _mod97(f"{country}{k:02}{body}"))
        return " ".join(whole[k : k + 4] for k in range(0, len(whole), 4)) if self.draw.random() < 0.5 else whole

    def national_id(self) -> str:
        return f"{self.draw.randint(100, 899)}{self.draw.choice('- ') if self.draw.random() < 0.2 else '-'}{self.digits(2)}-{self.digits(4)}"

    def other(self) -> str:
        """Something that looks alike and is no personal data."""
        d, draw = self.digits, self.draw
        failing = next(x for x in iter(lambda: d(16), None) if not luhn(x))
        book = next(x for x in iter(lambda: "978" + d(10), None) if not luhn(x))
        return draw.choice(
            [failing, failing, self.grouped(failing), f"{draw.randint(1900, 2100)}-{draw.randint(1, 12):02}-{draw.randint(1, 28):02}",
             f"{draw.randint(1, 28)}/{draw.randint(1, 12)}/{draw.randint(1900, 2100)}", f"version {draw.randint(1, 9)}.{draw.randint(0, 20)}",
             f"{draw.randint(1, 9)}.{draw.randint(0, 20)}.{draw.randint(0, 300)}", f"order {d(8)}", f"invoice no. {d(10)}", f"${d(3)}.{d(2)}",
             f'token = "{"".join(draw.choices("0123456789abcdef", k=40))}"', f'key = "{"".join(draw.choices("0123456789abcdef", k=32))}"',
             f"ISBN {book}", f"ISBN 978-{draw.randint(0, 9)}-{d(3)}-{d(5)}-{draw.randint(0, 9)}", f"{draw.randint(0, 23)}:{d(2)}:{d(2)}",
             str(draw.randint(1900, 2100)), f"page {d(3)}", f"{d(3)}.{d(3)}.{d(3)},{d(2)}", f"{d(2)}-{d(2)}", f"@{self.word()}", f"{self.word()} @ {d(2)}",
             f"look at {self.word()} dot by dot", f"connect the dot at {self.word()}", f"ref {d(12)}", f"{d(4)} {d(4)}", f"{d(6)} {d(5)} {d(7)}",
             f"{draw.randint(256, 999)}.{d(3)}.{d(3)}.{d(3)}", f"section {draw.randint(1, 9)}.{draw.randint(1, 9)}.{draw.randint(1, 9)}"]
        )

    def sentence(self) -> tuple[str, dict[tuple[int, int], int]]:
        """A text and the kind of each span of personal data in it."""
        text, gold = self.draw.choice(self.texts), {}
        for kind, a, b in plain_spans(text):
            if not any(a < y and x < b for x, y in gold):
                gold[a, b] = kind
        for _ in range(self.draw.choice([0, 1, 1, 2, 2, 3])):
            parts = []
            for _ in range(self.draw.choice([1, 1, 1, 2, 2, 3])):
                if self.draw.random() < 0.55:
                    kind = self.draw.choices(range(len(KINDS)), [5, 4, 4, 4, 2, 2])[0]
                    parts.append((kind, getattr(self, KINDS[kind])()))
                else:
                    parts.append((-1, self.other()))
            at = self.place(text, gold)
            glue = self.draw.choices([" ", ", ", " | ", "\n", "; ", "%%% ", "!! "], [8, 3, 1, 1, 1, 1, 1])[0]
            piece, inner = " ", []
            for kind, part in parts:
                if kind >= 0:
                    inner.append((at + len(piece), at + len(piece) + len(part), kind))
                piece += part + glue
            gold = {(a + len(piece) * (a >= at), b + len(piece) * (a >= at)): kind for (a, b), kind in gold.items()}
            gold |= {(a, b): kind for a, b, kind in inner}
            text = text[:at] + piece + text[at:]
        return text, gold

    def place(self, text: str, gold) -> int:
        """The end of a word outside all spans."""
        ends = [m.end() for m in re.finditer(r"[^\W\d_]+(?=[ .,]|$)", text) if not any(a <= m.end() <= b for a, b in gold)]
        return self.draw.choice(ends) if ends else 0


def train(texts: list[str], seed: int = 5, sentences: int = SENTENCES, rounds: int = ROUNDS) -> Field:
    """Weights from sentences made of these texts; equal for equal texts and seed."""
    maker = Maker(seed, texts)
    examples = []
    for _ in range(sentences):
        text, gold = maker.sentence()
        sentence = Sentence()
        sentence.add(text, 0, len(text), 0)
        first = {at: k for k, at in enumerate(sentence.starts) if at >= 0}
        first[len(text)] = len(sentence.starts) - 1
        spans = Spans(sentence, 0, len(sentence.types))
        known = set(zip(spans.start.tolist(), spans.stop.tolist(), strict=True))
        marked = {(first.get(a), first.get(b)): kind for (a, b), kind in gold.items()}
        if known >= marked.keys():  # a span of the sample may be longer than any candidate
            examples.append((len(sentence.types), spans, marked))
    field = Field()
    squares = [np.full_like(field.weights, 1e-6), np.full_like(field.follow, 1e-6)]
    order = random.Random(seed)
    for _ in range(rounds):
        order.shuffle(examples)
        for at in range(0, len(examples), 10):
            batch = examples[at : at + 10]
            steps = [-0.01 * field.weights, -0.01 * field.follow]
            for n, spans, gold in batch:
                _, by_weight, by_follow = gradient(field, n, spans, gold)
                steps[0] += by_weight
                steps[1] += by_follow
            for value, step, square in zip((field.weights, field.follow), steps, squares, strict=True):
                square += step * step
                value += 0.5 * step / np.sqrt(square)
    return field


def sample_windows(docs: DataFrame, seed: int, sample_docs: int = SAMPLE_DOCS) -> list[str]:
    """Windows of texts chosen by hash: around digits and @ signs, and elsewhere."""

    def run(batches):
        for batch in batches:
            out = []
            for text in batch.column(0).to_pylist():
                draw = random.Random(len(text))
                found = windows(text)
                places = [draw.randrange(a, b) for a, b in draw.sample(found, min(WINDOWS // 2, len(found)))]
                places += [draw.randrange(len(text)) for _ in range(WINDOWS // 2)]
                for at in places:
                    begin, end = max(at - 90, 0), at + 90
                    part = re.sub(r"^[0-9A-Za-z@.+_%-]*", "", text[begin:end]) if begin else text[:end]
                    part = re.sub(r"[0-9A-Za-z@.+_%-]*$", "", part) if end < len(text) else part
                    numbers = [digits_of(m[0]) for p in (CARD, PHONE) for m in p.finditer(part)]
                    if part.strip() and all(len(d) < 17 for d in numbers):  # several numbers in one would be taught as none
                        out.append(part)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["part"])

    # the hashes alone tell which texts are least, so that no other text is moved
    hashed = docs.where(F.length("text") > 0).select(F.xxhash64(F.lit(seed), "text").alias("hash"), "text")
    least = [r.hash for r in hashed.select("hash").orderBy("hash").limit(sample_docs).collect()]
    chosen = hashed.where(F.col("hash") <= F.lit(least[-1] if least else 0)).orderBy("hash", "text").limit(sample_docs)
    parts = chosen.select("text").mapInArrow(run, "part string").collect()
    return sorted(r.part for r in parts)


# ---------------------------------------------------------------- texts


def found_spans(field: Field, texts: list[str]) -> list[list[tuple[int, int, int, bool]]]:
    """Spans of each text: kind, start, end, and whether a fixed pattern found it."""
    plain = [plain_spans(text) for text in texts]
    sentence = Sentence()
    for owner, text in enumerate(texts):
        for begin, end in windows(text):
            sentence.add(text, begin, end, owner)
    n = len(sentence.types)
    starts, stops, scores = [], [], []
    for begin in range(0, n, BLOCK):
        spans = Spans(sentence, begin, min(begin + BLOCK, n))
        value = field.scores(spans)
        some = value.max(1, initial=-np.inf) > -30
        starts.append(spans.start[some])
        stops.append(spans.stop[some])
        scores.append(value[some])
    chosen = best_segments(field, n, np.concatenate(starts), np.concatenate(stops), np.concatenate(scores)) if n > 1 else []
    out = [[(kind, a, b, True) for kind, a, b in spans] for spans in plain]
    taken = [np.array(sorted((a, b) for _, a, b in spans)).reshape(-1, 2) for spans in plain]
    ends = [np.maximum.accumulate(spans[:, 1]) for spans in taken]
    for first, stop, kind in chosen:
        owner = sentence.owners[first]
        a, b = sentence.starts[first], sentence.starts[stop - 1] + len(sentence.words[stop - 1])
        before = int(np.searchsorted(taken[owner][:, 0], b))  # spans that start before b
        if not before or ends[owner][before - 1] <= a:
            out[owner].append((kind, a, b, False))
    return [sorted(spans) for spans in out]


def masked(text: str, spans: list[tuple[int, int, int, bool]]) -> str:
    """The text with <KIND> in place of each span; of overlapping ones the first gives the name."""
    out, at = [], 0
    for kind, a, b, _ in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if a >= at:
            out += [text[at:a], f"<{KINDS[kind].upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def find_personal_data(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 5, sample_docs: int = SAMPLE_DOCS, mask: bool = False
) -> DataFrame:
    """doc_id and spans of every row: kind, start, end (code points, end exclusive), and fixed, true for plain forms.

    Spans are ordered by kind (as in KINDS), then start. With mask, masked_text has
    ``<KIND>`` in place of each. Other columns are ignored, whatever their names.

    A null or empty text has no spans; a null masked_text stays null. Ids may be null
    and repeat: each row has its own result, equal for equal texts. Training uses
    sample_docs texts with the least hashes, so reruns agree on any layout. No rows
    give no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    docs = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    field = train(sample_windows(docs, seed, sample_docs), seed)
    parts = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("fixed", pa.bool_())])
    schema = f"doc_id {kind}, spans array<struct<kind:string,start:bigint,end:bigint,fixed:boolean>>"

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                ids, texts = batch.column(0).slice(at, 256), batch.column(1).slice(at, 256).to_pylist()
                found = found_spans(field, [text or "" for text in texts])
                rows = [[{"kind": KINDS[k], "start": a, "end": b, "fixed": f} for k, a, b, f in spans] for spans in found]
                columns = {"doc_id": ids, "spans": pa.array(rows, pa.list_(parts))}
                if mask:
                    hidden = [None if t is None else masked(t, s) for t, s in zip(texts, found, strict=True)]
                    columns["masked_text"] = pa.array(hidden, pa.string())
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return docs.mapInArrow(run, schema + (", masked_text string" if mask else ""))


def span_list(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    each = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(each, ",")
