"""Personal data: four patterns as the base, and a linear-chain conditional random field that adds spans.

The patterns are searched in time linear in the text, whatever it holds. The field labels the words of
each line by their shapes and their neighbours' shapes, as the four kinds or as a secret (a key or token given away). It is
trained from a small labelled table: lines of the corpus itself, whose base spans are the labels, the same lines with
those spans written in ways that the patterns miss (``variant``), and sentences by written-out rules (``labelled_table``).
It is decoded by Viterbi over many lines at once. A line in which no word can gain enough for any label is all O without decoding, by a bound
on every path's score. Spans of the field that touch a base span are dropped: base ones stay as they are.
"""

from __future__ import annotations

import hashlib
import random
import re
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, bounded_sample, mapped, rows_of

#: Kinds of the base.
KINDS = ("email", "ip", "card", "phone")
#: Kinds that the field labels, in the order in which spans are listed.
FOUND = (*KINDS, "secret")
LABELS = ("O", *FOUND)

# Base patterns

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of local part, @, dotted domain. Each @ is looked at once, with the local part before it."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            last = m.end()
        else:
            last = max(last, at + 1)
        at = text.find("@", max(at + 1, last))
    return out


def ips(text: str) -> list[tuple[int, int]]:
    """Four dotted numbers of at most 255 each: a run of dotted numbers is taken by fours from its start."""
    out = []
    for m in _DOTTED.finditer(text):
        if m[0].count(".") < 3:
            continue
        parts, at = m[0].split("."), m.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p[-4:] if len(p) > 4 else p) <= 255 for p in four):
                out.append((at, end))
            at = end + 1
    return out


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def cards(text: str) -> list[tuple[int, int]]:
    out = []
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append(m.span())
    return out


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then kind as in KINDS."""
    found = [("email", *s) for s in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        found += [("ip", *s) for s in ips(text)] + [("card", *s) for s in cards(text)]
        found += [("phone", *s) for s in phones(text)] if "+" in text else []
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


_WORDS = re.compile(WORD)

# The labelled table

_CUES = {
    word: cue
    for cue, words in {
        "at": "at", "at()": "(at) [at] {at}", "dot": "dot", "dot()": "(dot) [dot] {dot}",
        "tel": "tel tel: phone phone: call fax mobile telefon telefon: handy téléphone téléphone: appelez teléfono teléfono: móvil llame",
        "mail": "email e-mail mail email: mail: courriel correo correo:", "card": "card card: visa karte kreditkarte carte carte: tarjeta tarjeta:", "ip": "ip ip: host server",
        "key": "token token: token= key key: key= secret secret: password password: passwort passwort: clave clave: api_key api_key= apikey",
    }.items() for word in words.split()
}


def labelled_table(n: int = 700, seed: int = 11) -> list[list[tuple[str, str]]]:
    """Sentences of (word, label), by rules: filler words, with personal data and with look-alikes that aren't."""
    r = random.Random(seed)
    syllables = "an en in on er re th sh li to ka mo da su pe vi ro ne la gu ö é ñ".split()
    num = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    word = lambda: "".join(r.choice(syllables) for _ in range(r.randint(1, 4)))
    name = lambda: "".join(c for c in word() if c.isascii()) or "ana"
    host = lambda: name() + r.choice(["", num(1)])
    end = lambda: r.choice(["com", "org", "net", "de", "example"])
    filler = lambda: (r.choice([str.lower, str.lower, str.lower, str.title])(word()) + r.choice(["", "", "", "", ",", ".", ";"]), "O")
    cue = lambda k: [(r.choice([c for c, v in _CUES.items() if v == k]), "O")]

    def positive() -> list[tuple[str, str]]:
        kind = r.randrange(13)
        if kind >= 11:
            mark = r.choice(["=", ":", ""])
            value = "".join(r.choice("0123456789abcdef" if kind == 11 else "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(r.randint(20, 48))) + num(1) + "f"
            quote = r.choice(['"', '"', "'", ""])
            return cue("key") + [(mark, "O")] * bool(mark) + [(f"{quote}{value}{quote}", "secret")]
        if kind == 0:
            return [(f"{name()}.{num(2)}@{host()}.{end()}", "email")]
        if kind == 1:
            return [(w, "email") for w in (name(), "at", host(), "dot", end())]
        if kind == 2:
            a, d = r.choice([("(at)", "(dot)"), ("[at]", "[dot]"), ("{at}", "{dot}")])
            return [(w, "email") for w in (name(), a, host(), d, end())]
        if kind == 3:
            a = r.choice(["(at)", "[at]", "{at}"])
            return [(w, "email") for w in (name() + r.choice(["", "." + name()]), a, f"{host()}.{end()}")]
        if kind == 4:
            return [(w, "phone") for w in (f"+{num(1)}", f"({num(3)})", f"{num(3)}-{num(4)}")]
        if kind == 5:
            return [(w, "phone") for w in (f"({num(3)})", f"{num(3)}-{num(4)}")]
        if kind == 6:
            return cue("tel") + [(f"{num(3)}-{num(3)}-{num(4)}", "phone")]
        if kind == 7:
            return cue("tel") + [(w, "phone") for w in (num(4), num(3), num(4))]
        if kind == 8:
            return cue("card") + [(w, "card") for w in (num(4), num(4), num(4), num(4))]
        if kind == 9:
            return cue("card") * r.randrange(2) + [(num(16), "card")]
        return cue("ip") + [(f"{num(2)}.{num(2)}.{num(3)}.{num(2)}", "ip")]

    def negative() -> list[tuple[str, str]]:
        kind = r.randrange(16)
        plain = [
            num(4), num(r.randint(1, 3)), f"{num(1)}.{num(2)}", f"{num(1)}.{num(1)}.{num(1)}", f"{num(4)}-{num(2)}-{num(2)}", f"{num(2)}/{num(2)}/{num(4)}", f"{num(2)}:{num(2)}",
            f"{num(2)}-{num(2)}", f"({num(4)})", num(r.randint(20, 30)), num(r.randint(5, 11)), f"{num(2)}.{num(2)}.{num(3)}.{num(2)}", f"v{num(1)}.{num(1)}.{num(1)}", f"({num(1)})",
        ]
        if kind == 14:
            return [filler(), ("at", "O"), filler(), filler()]
        if kind == 15:
            return [filler(), ("dot", "O"), filler()]
        return [(plain[kind] + r.choice(["", "", ",", "."]), "O")]

    def oddity() -> list[tuple[str, str]]:
        """Lines that aren't prose: all capitals, separators, symbols, one word again and again, cue words alone."""
        kind = r.randrange(5)
        one = word()
        mark = r.choice(["!!", "***", "%%%", "$$$", "&&&", "###", ",!!"])
        words = [[f"{word().upper()}{mark}" for _ in range(8)], [x for _ in range(6) for x in (word(), "|")], [word() + mark for _ in range(8)], [one.title()] * r.randint(3, 9), [r.choice([*_CUES, "At", "The", "Of", "|"]) for _ in range(4)]]
        return [(w, "O") for w in words[kind]]

    out = []
    for k in range(n):
        if k % 5 == 4:
            out.append(oddity())
            continue
        sentence = [filler() for _ in range(r.randint(2, 7))]
        if k % 3:
            sentence += positive() if k % 3 == 1 else negative()
            sentence += [filler() for _ in range(r.randint(0, 6))]
            if k % 2:
                sentence += negative() + [filler() for _ in range(r.randint(1, 3))]
        out.append(sentence)
    return out


def variant(kind: str, span: str, r: random.Random) -> list[str]:
    """The words of a base span written so that the patterns miss it."""
    if kind == "email":
        local, _, domain = span.partition("@")
        at, dot = r.choice([("at", "dot"), ("(at)", "(dot)"), ("[at]", "[dot]"), ("{at}", "{dot}")])
        return [local, at, *(domain.replace(".", f" {dot} ").split() if at == "at" or r.random() < 0.6 else [domain])]
    digits = "".join(_DIGIT.findall(span))
    if kind == "ip":
        return [span.replace(".", "[.]")]
    if kind == "card":  # one digit is misread
        k = r.randrange(len(digits))
        wrong = digits[:k] + str((int(digits[k]) + r.randint(1, 9)) % 10) + digits[k + 1 :]
        wrong = wrong if not luhn(wrong) else wrong[:-1] + str((int(wrong[-1]) + 1) % 10)
        return [wrong] if r.random() < 0.6 else re.findall("[0-9]{1,4}", wrong)
    ten = digits[-10:].rjust(10, "0")
    return [f"({ten[:3]})", f"{ten[3:6]}-{ten[6:]}"] if r.random() < 0.6 else [r.choice(["tel", "telefon", "téléphone", "teléfono"]), f"{ten[:3]}-{ten[3:6]}-{ten[6:]}"]


def sentences_of(line: str, r: random.Random, around: int = 6) -> list[list[tuple[str, str]]]:
    """The words near each base span of a line with their labels, and those words with a variant in the span's place; without base spans its first words, as O.

    What looks like a misread card or a quoted key is labelled so, since lines of a corpus hold those, too.
    """
    words = [(m[0], *m.span()) for m in _WORDS.finditer(line)]
    rule = lambda w: "card" if re.fullmatch(r"[0-9]{12,19}", w.strip(_EDGE)) else "secret" if shape(w.encode()).startswith("mixed") and w[:1] in "\"'" else "O"
    found = base_spans(line)
    label = lambda w, p, q: next((k for k, x, y in found if p < y and x < q), rule(w))
    tagged = [(w, label(w, p, q)) for w, p, q in words]
    if not found:
        return [tagged[: 2 * around]] if tagged else []
    out = []
    for kind, x, y in found:
        inside = [k for k, (_, p, q) in enumerate(words) if p < y and x < q]
        left, right = tagged[max(0, inside[0] - around) : inside[0]], tagged[inside[-1] + 1 : inside[-1] + 1 + around]
        new = variant(kind, line[x:y], r)
        out += [[*left, *tagged[inside[0] : inside[-1] + 1], *right], [*left, *((w, "O" if w.isalpha() and kind == "phone" else kind) for w in new), *right]]
    return out


def corpus_table(docs: DataFrame, most: int = 3_000, lines: int = 150, widest: int = 400, id_col: str = "doc_id", text_col: str = "text") -> list[list[tuple[str, str]]]:
    """The labelled table from the corpus: ``lines`` lines with digits or an @, and as many without, of at most ``widest`` characters, from ``most`` documents by the hash of their ids."""
    ids = bounded_sample(docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id")), most)
    some = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(ids.distinct()), "doc_id", "left_semi")  # at most ``most`` ids
    parts = some.select(F.explode(F.split("text", "\n")).alias("line")).where(F.char_length("line").between(1, widest)).distinct()
    r, out = random.Random(5), []
    for marked in (True, False):
        rows = parts.where(F.col("line").rlike("[0-9@]") == F.lit(marked)).orderBy(F.xxhash64("line"), "line").limit(lines).collect()
        out += [s for row in rows for s in sentences_of(row["line"], r)]
    return out


# The field

_RUN = re.compile(r"[0-9]+|[^\W\d_]+")
_EDGE = ".,;:!?#%$&*|\"'"
_MIXED = re.compile(r"[A-Za-z0-9_+/=-]{16,}")


def shape(word: bytes) -> str:
    """Runs of letters as a, or A if they start with a capital; runs of digits as 9 and their length, from 5 on in classes; cue words as such; marks of noise at the end go.

    A long word of letters and digits without other marks is mixed, in its quotes if it has any.
    """
    w = word.decode("utf-8", "replace")
    if cue := _CUES.get(w.lower()):
        return f"cue {cue}"
    w = w.rstrip("!#%$&*|") or w
    core = w.strip(_EDGE)
    if len(core) <= 200 and _MIXED.fullmatch(core) and sum(c.isdigit() for c in core) >= 3 and re.search("[A-Za-z]", core):
        return f"mixed {w[:1] if w[:1] in _EDGE else ''}"
    if len(w) > 60:
        return "long"
    size = lambda n: n if n < 5 else 5 if n < 12 else 6 if n < 20 else 7
    mark = lambda m: f"9{size(len(m[0]))}" if m[0][0].isdigit() else "A" if m[0][0].isupper() else "a"
    return _RUN.sub(mark, w)[:24]


def flags(s: str) -> list[str]:
    """What a shape that the table doesn't have is known by."""
    return [f"shape {s}", f"digit {'9' in s}", f"at {'@' in s}", f"plain {s.rstrip('.,;:!?') in ('a', 'A')}", f"cue {s.startswith('cue ')}", f"end {s[-1:] in '.,;:!?'}", f"dots {min(s.count('.'), 4)} {'[.]' in s}"]


@dataclass
class Field:
    """weight[feature]: (3, labels) for the word itself, the one before it, the one behind it. move: from label to label."""

    weight: dict[str, np.ndarray]
    move: np.ndarray
    ids: dict[bytes, int] = field(default_factory=dict, repr=False)
    shapes: dict[str, int] = field(default_factory=dict, repr=False)
    rows: list = field(default_factory=list, repr=False)

    def __reduce__(self):
        return Field, (self.weight, self.move)

    def row(self, s: str) -> np.ndarray:
        zero = np.zeros((3, len(LABELS)))
        return sum((self.weight.get(f, zero) for f in flags(s)), zero)

    def id_of(self, word: bytes) -> int:
        if (k := self.ids.get(word)) is None:
            s = shape(word)
            if (k := self.shapes.get(s)) is None:
                k = self.shapes[s] = len(self.rows)
                self.rows.append(self.row(s).astype(np.float32))
            if len(self.ids) > 300_000:
                self.ids.clear()
            if len(word) <= 64:
                self.ids[word] = k
        return k

    def forget(self) -> None:
        """Empty the memos. Ids given before mean nothing afterwards, so no line may hold any."""
        self.shapes, self.rows, self.ids = {}, [], {}

    def emissions(self, lines: list[np.ndarray], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(words, labels) of all lines one behind the other, and where each starts. table: rows of the ids."""
        flat = np.concatenate(lines)
        start = np.cumsum([0, *map(len, lines)])
        e = table[flat, 0].copy()
        first, last = start[:-1], start[1:] - 1
        before, behind = table[np.r_[flat[:1], flat[:-1]], 1], table[np.r_[flat[1:], flat[-1:]], 2]
        before[first], behind[last] = 0, 0
        e += before
        e += behind
        return e, start

    def decode(self, lines: list[np.ndarray], table: np.ndarray) -> dict[int, np.ndarray]:
        """Labels of the lines that aren't all O, by number. Viterbi, a step over all lines that are long enough at once."""
        lines_at = [k for k, x in enumerate(lines) if len(x)]
        if not lines_at:
            return {}
        e, start = self.emissions([lines[k] for k in lines_at], table)
        # Over all O, a run of other labels gains each word's margin, what moving on within the run gains, and what entering and
        # leaving it do (nothing at a line's ends). So where no word's sum is positive, O it is.
        gain = self.move - self.move[0, 0]
        ends = max(0.0, float(gain[0, 1:].max())) + max(0.0, float(gain[1:, 0].max()))
        most = e[:, 1:].max(1) - e[:, 0] + max(0.0, float(gain[1:, 1:].max())) + ends
        todo = np.flatnonzero(np.maximum.reduceat(most, start[:-1]) > 0)
        todo = todo[np.argsort(start[todo] - start[todo + 1], kind="stable")]  # longest first
        out, at = {}, 0
        while at < len(todo):
            many = max(1, 2_000_000 // int(start[todo[at] + 1] - start[todo[at]]))
            for line, labels in self._viterbi(e, start, todo[at : at + many]):
                if labels.any():
                    out[lines_at[line]] = labels
            at += many
        return out

    def _viterbi(self, e: np.ndarray, start: np.ndarray, lines: np.ndarray):
        """(line, labels) of lines, longest first."""
        sizes = start[lines + 1] - start[lines]
        back = np.zeros((int(sizes[0]), len(lines), len(LABELS)), np.int8)
        best = e[start[lines]].astype(np.float64)
        for t in range(1, int(sizes[0])):
            on = int(np.searchsorted(-sizes, -t, "left"))  # lines longer than t
            ways = best[:on, :, None] + self.move[None]
            back[t, :on] = ways.argmax(1)
            best[:on] = ways.max(1) + e[start[lines[:on]] + t]
        label, got, cols = best.argmax(1), np.zeros((int(sizes[0]), len(lines)), np.int8), np.arange(len(lines))
        for t in range(int(sizes[0]) - 1, -1, -1):
            on = int(np.searchsorted(-sizes, -t, "left"))
            got[t, :on] = label[:on]
            if t:
                label[:on] = back[t, cols[:on], label[:on]]
        for k, line in enumerate(lines.tolist()):
            yield line, got[: sizes[k], k]


def train(table: list[list[tuple[str, str]]], rounds: int = 100, ridge: float = 0.003) -> Field:
    """Maximum likelihood with a ridge, by gradient steps over the whole table; deterministic."""
    n_labels, index = len(LABELS), {}
    sentences = []
    for s in table:
        feats = [[index.setdefault(f, len(index)) for f in flags(shape(w.encode()))] for w, _ in s]
        sentences.append((feats, [LABELS.index(y) for _, y in s]))
    width = max(len(f) for f, _ in sentences)
    n, k = len(sentences), len(flags("a"))
    x = np.zeros((n, width, k), np.int64)
    y = np.zeros((n, width), np.int64)
    there = np.zeros((n, width), bool)
    for i, (feats, labels) in enumerate(sentences):
        x[i, : len(feats)], y[i, : len(labels)], there[i, : len(feats)] = feats, labels, True
    size = there.sum(1)
    w, move = np.zeros((len(index), 3, n_labels)), np.zeros((n_labels, n_labels))
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(move), np.zeros_like(move)]
    gold = np.eye(n_labels)[y] * there[:, :, None]
    for step in range(1, rounds + 1):
        own, before, behind = (w[x, c].sum(2) * there[:, :, None] for c in range(3))
        e = own
        e[:, 1:] += before[:, :-1] * there[:, 1:, None]
        e[:, :-1] += behind[:, 1:] * there[:, :-1, None]
        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        alpha[:, 0] = e[:, 0]
        for t in range(1, width):
            alpha[:, t] = e[:, t] + _lse(alpha[:, t - 1, :, None] + move, 1)
        for t in range(width - 2, -1, -1):
            beta[:, t] = np.where((t + 1 < size)[:, None], _lse(move + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2), 0)
        z = _lse(alpha[np.arange(n), size - 1], 1)
        p = np.exp(alpha + beta - z[:, None, None]) * there[:, :, None]
        diff = (gold - p) / n
        gw = np.zeros_like(w)
        for c, d in ((0, diff), (1, np.concatenate([diff[:, 1:], np.zeros((n, 1, n_labels))], 1)), (2, np.concatenate([np.zeros((n, 1, n_labels)), diff[:, :-1]], 1))):
            for label in range(n_labels):
                gw[:, c, label] = np.bincount(x.reshape(-1), np.repeat((d[:, :, label] * there).reshape(-1), k), len(index))
        gm = np.zeros_like(move)
        for t in range(1, width):
            on = there[:, t]
            pair = np.exp(alpha[on, t - 1, :, None] + move + (e[on, t] + beta[on, t])[:, None, :] - z[on, None, None])
            gm += ((gold[on, t - 1, :, None] * gold[on, t, None, :]) - pair).sum(0) / n
        for v, g, m1, m2 in ((w, gw - ridge * w / 10, *state[:2]), (move, gm - ridge * move / 10, *state[2:])):
            m1 += 0.1 * (g - m1)
            m2 += 0.01 * (g * g - m2)
            v += 0.15 * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-8)
    return Field({f: w[i] for f, i in index.items()}, move)


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis)
    return top + np.log(np.exp(x - np.expand_dims(top, axis)).sum(axis))


def plausible(kind: str, span: str) -> bool:
    """Whether a span has what its kind can't do without, since a field labels words and not wholes."""
    digits = sum(c.isdigit() for c in span)
    if kind == "email":
        if not re.match(r"\S*[A-Za-z]", span) or not re.search(r"[A-Za-z]{2,}\W*\Z", span):
            return False
        if "@" in span:
            return "." in span
        words = span.split()
        cues = [_CUES.get(w.lower(), "") for w in words]
        at = next((k for k, c in enumerate(cues) if k and c.startswith("at")), None)
        # Written-out addresses have one at, which begins no sentence, and behind it a domain of two labels or more.
        if at is None or words[at][:1].isupper() or words[at - 1][-1] in _EDGE or sum(c.startswith("at") for c in cues) > 1:
            return False
        domain = "".join("." if c.startswith("dot") else w for w, c in zip(words[at + 1 :], cues[at + 1 :])).rstrip(_EDGE)
        return bool(_DOMAIN.fullmatch(domain))
    return {"ip": digits >= 4 and span.count(".") >= 3, "card": 12 <= digits <= 19, "phone": 7 <= digits <= 15, "secret": bool(_MIXED.fullmatch(span))}[kind]


def added_spans(texts: list[str], model: Field, base: list[list[tuple[str, int, int]]], words_at_once: int = 200_000, most_shapes: int = 50_000) -> list[list[tuple[str, int, int]]]:
    """Spans of the field in each text that touch none of its base spans. Shapes are forgotten between lines, beyond ``most_shapes``; one line may have more."""
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    lines, of, held = [], [], 0
    places: dict[int, tuple[list[str], list[int]]] = {}  # of texts in work: lines, and where each starts

    def work():
        nonlocal lines, of, held
        for text in places.keys() - {text for text, _ in of}:
            del places[text]
        for k, labels in model.decode(lines, np.stack(model.rows) if model.rows else np.zeros((0, 3, len(LABELS)), np.float32)).items():
            text, number = of[k]
            if text not in places:
                parts = texts[text].split("\n")
                places[text] = parts, list(accumulate((len(x) + 1 for x in parts), initial=0))
            start, line = places[text][1][number], places[text][0][number]
            spans = [m.span() for m in _WORDS.finditer(line)]
            at = 0
            while at < len(labels):
                end = at
                while end < len(labels) and labels[end] == labels[at]:
                    end += 1
                if labels[at]:
                    a, b = spans[at][0], spans[end - 1][1]
                    b = a + len(line[a:b].rstrip(_EDGE))
                    a = b - len(line[a:b].lstrip(_EDGE))
                    if b > a and plausible(LABELS[labels[at]], line[a:b]) and all(start + b <= p or q <= start + a for _, p, q in base[text]):
                        out[text].append((LABELS[labels[at]], start + a, start + b))
                at = end
        lines, of, held = [], [], 0

    for k, text in enumerate(texts):
        for number, line in enumerate(text.encode("utf-8", "surrogatepass").split(b"\n")):
            if len(model.rows) > most_shapes:  # only here, where no line is half done
                work()
                model.forget()
            words = line.split()
            lines.append(np.fromiter(map(model.id_of, words), np.int64, len(words)))
            of.append((k, number))
            held += len(words)
            if held >= words_at_once:
                work()
    work()
    return out


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", table: list[list[tuple[str, str]]] | None = None) -> DataFrame:
    """One row per row of ``docs``: the id, n_email, n_ip, n_card, n_phone (base), base_sha256, spans, n_added, n_spans.

    base_sha256 is that of the base spans, ``spans`` has them and the field's, as kind:start:end by start, then kind,
    comma-joined; positions are code points, the end is exclusive. Without a ``table`` the field learns from written-out rules and
    a bounded sample of the corpus' lines (``corpus_table``). Null texts count as empty; repeated rows give
    equal rows; an empty table gives an empty one; other columns aren't read. Narrow, but for that sample.
    """
    model = train(table or labelled_table() + corpus_table(docs, id_col=id_col, text_col=text_col))

    def run(batches):
        for b in batches:
            ids, texts = zip(*((i, t or "") for i, t in rows_of(b, "id", "text"))) if b.num_rows else ((), ())
            base = [base_spans(t) for t in texts]
            added = added_spans(list(texts), model, base)
            out = []
            for i, found, more in zip(ids, base, added):
                spans = sorted(found + more, key=lambda s: (s[1], FOUND.index(s[0]), s[2]))
                out.append((i, *(sum(s[0] == k for s in found) for k in KINDS), hashlib.sha256(joined(found).encode()).hexdigest(), joined(spans), len(more), len(spans)))
            cols = list(zip(*out)) if out else [()] * 9
            types = [b.schema.field("id").type, *[pa.int64()] * 4, pa.string(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added", "n_spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, {', '.join(f'n_{k} long' for k in KINDS)}, base_sha256 string, spans string, n_added long, n_spans long"
    return mapped(docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")), run, schema).withColumnRenamed("id", id_col)


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first counts."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], FOUND.index(s[0]))):
        if a >= at:
            out += [text[at:a], f"[{kind}]"]
            at = b
    return "".join([*out, text[at:]])
