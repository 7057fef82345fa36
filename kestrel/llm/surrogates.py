"""PII: keyed surrogates for detected entities.

Entities are found in whole texts.  Each distinct entity of the corpus (type and canonical form) gets a
surrogate drawn from a keyed hash: of the same type, and of the same format as each mention (digits for
digits, letters of the same case and script, check digits kept valid, names by gender and script).  The
same entity gets the same surrogate everywhere and in whatever way it is written.  Surrogates are checked
over the whole corpus: one that equals another entity's surrogate, or any real entity, is drawn again, until
all are distinct.
A person is found by a title, and then wherever the same text has that name or its surname (capitalised as there, or in
capitals) without one; a surname stands for the fuller name of the text that goes with its title (the last one before it, else the
next).  Given names alone are not followed.  A name is one entity whatever its titles; they decide its surrogate's
gender where they agree over the corpus.  An entity that finds none in its own format within ``attempts`` rounds gets a longer one.

Defined results: a masked secret or key (no letter or digit in it) is no entity; a null or empty text stays as it is; rows that repeat an id are rewritten each by its own
text; an empty table gives an empty result; the other columns are passed through untouched.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from collections.abc import Callable, Iterator
from itertools import count

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.llm.common import ID, ROW, TEXT, fresh_name, keyed_texts, narrowed, split_by_keys, stage, text_slices, tidy

# --- detection -------------------------------------------------------------------------------------

#: titles by the gender they tell
TITLES = {
    "f": ["Mrs", "Ms", "Miss", "Madam", "Frau", "Señora", "Sra", "Madame", "Mme", "Signora", "г-жа", "госпожа", "κυρία"],
    "m": ["Mr", "Mister", "Herr", "Señor", "Sr", "Monsieur", "Signor", "г-н", "господин", "κύριος"],
    "n": ["Dr", "Prof", "Mx"],
}
_GENDER = {t.lower(): g for g, ts in TITLES.items() for t in ts}
_TITLE = "|".join(sorted((re.escape(t) for ts in TITLES.values() for t in ts), key=len, reverse=True))

#: in order of precedence: an entity inside an earlier one is not looked at
PATTERNS = {
    "key": r"-----BEGIN [A-Z ]*PRIVATE KEY-----[\s\S]*?-----END [A-Z ]*PRIVATE KEY-----",
    "email": r"(?<![\w.+%-])[\w.+%-]+@(?:[\w-]+\.)+[^\W\d_]{2,}",
    "secret": (r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])|(?<!\w)(?:ghp_|gho_|sk-|xox[bp]-)[A-Za-z0-9_-]{16,}"
               r"|(?i:(?<![^\W_])(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key))\s*[:=]\s*(?:\"[^\"\s]{6,}\"|'[^'\s]{6,}'|[^\s\"',;]{6,})"),
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "ip": r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\w|\.\d)",
    "card": r"(?<![\w.+-])\d(?:[ -]?\d){12,18}(?![\w-])",
    "ssn": r"(?<![\w.+-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "phone": r"(?<![\w.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?)\d{3,4}(?:[ .-]\d{2,4}){1,3}(?!\w)|(?<![\w.])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\w)"
             r"|(?<![\w.+-])\d{3}[ .-]\d{3}[ .-]\d{4}(?![\w-])",
    "name": rf"(?<!\w)(?:{_TITLE})\.?[ ]+[^\W\d_a-zа-яα-ω][^\W\d_]+(?:[ -][^\W\d_a-zа-яα-ω][^\W\d_]+)?",
}
_FIND = re.compile("|".join(f"(?P<{k}>{p})" for k, p in PATTERNS.items()))
#: the first word of every entity holds a digit, a keyword or one of these signs
_TITLE_SIGNS = [f"{t}{dot} " for ts in TITLES.values() for t in ts for dot in ("", ".")]
_SIGNS = ["@", "-----BEGIN", "AKIA", "ASIA", "ghp_", "gho_", "sk-", "xox", *_TITLE_SIGNS]
_KEYWORD = re.compile(r"(?i)passw|pwd|secret|token|key")


def may_hold(texts: pa.Array) -> pa.Array:
    """A quick pass over all texts: False where no entity can be."""
    return pc.match_substring_regex(texts, "[0-9:=]|" + "|".join(re.escape(sign) for sign in _SIGNS))


_KEY_MARKS = re.compile(r"-----(?:BEGIN|END) [A-Z ]*PRIVATE KEY-----")
_SECRET_HEAD = re.compile(r"(?i)(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)\s*[:=]\s*[\"']?|AKIA|ASIA|gh[po]_|sk-|xox[bp]-")


def luhn_sum(digits: str) -> int:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total


def iban_rest(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


#: length of an IBAN by country
_IBAN_LENGTH = {c: n for n, cs in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC",
    32: "LC", 33: "RU"}.items() for c in cs.split()}


def _iban_length(found: str) -> int | None:
    """The length of the IBAN that ``found`` begins with: its country's, or the most whole groups with a right checksum."""
    ends = [len(found), *(m.start() for m in reversed(list(re.finditer(" ", found))))]
    sizes = {end: end - found.count(" ", 0, end) for end in ends}
    right = _IBAN_LENGTH.get(found[:2])
    for end in sorted(ends, key=lambda end: (sizes[end] != right, -end)):
        if 15 <= sizes[end] <= 34 and iban_rest(found[:end].replace(" ", "")) == 1:
            return end
    return None


def _phone_length(found: str) -> int | None:
    """The length of the most whole groups that make a number of 7 to 15 digits."""
    for end in [len(found), *(m.start() for m in reversed(list(re.finditer(r"(?<=\w)\W+", found))))]:
        if 7 <= sum(c.isdigit() for c in found[:end]) <= 15:
            return end
    return None


def _matches(text: str) -> Iterator[tuple[str, int, int]]:
    """(type, start, end): what ``_FIND.finditer`` gives, but tried only in words up to a place that can begin an entity.

    An IBAN or phone number that takes in too much is cut to what is one; where none is, the search goes on at the next character.
    """
    places = {m.start() for m in re.finditer(r"\d", text)}
    for sign in _SIGNS:
        at = text.find(sign)
        while at >= 0:
            places.add(at)
            at = text.find(sign, at + 1)
    if ":" in text or "=" in text:
        places |= {m.start() for m in _KEYWORD.finditer(text)}
    tried = 0
    for place in sorted(places):
        if place < tried:
            continue
        at = place
        while at > tried and not text[at - 1].isspace():
            at -= 1
        for p in range(at, place + 1):
            tried = p + 1
            if m := _FIND.match(text, p):
                cut = {"iban": _iban_length, "phone": _phone_length}.get(m.lastgroup, len)(m.group())
                if cut is None:
                    continue
                yield m.lastgroup, p, p + cut
                tried = max(tried, p + cut)
                break


def _plain_name(name: str) -> str:
    return " ".join(name.replace("-", " ").casefold().split())


def _with_untitled(text: str, found: list[tuple[int, int, str, str, str | None]]) -> list[tuple[int, int, str, str, str | None]]:
    """The entities of a text with the untitled mentions of its titled names; surnames stand for the fuller name."""
    names = [e for e in found if e[2] == "name"]
    if not names:
        return found
    forms: dict[str, None] = {}
    fuller: dict[str, list[tuple[int, str]]] = {}
    genders: dict[str, set[str]] = {}
    for start, end, _, canonical, gender in names:
        whole = text[start:end]
        first, _, last = whole.partition(" ")
        forms |= dict.fromkeys([whole, whole.upper()])
        if last:
            forms |= dict.fromkeys([last, last.upper()])
            fuller.setdefault(_plain_name(last), []).append((start, canonical))
        if gender:
            genders.setdefault(canonical, set()).add(gender)

    def person(at: int, canonical: str, gender: str | None) -> str:
        fit = [(start, c) for start, c in fuller.get(canonical, []) if not gender or gender in genders.get(c, {gender})]
        before = [c for start, c in fit if start < at]
        return before[-1] if before else fit[0][1] if fit else canonical

    words = "|".join(r"[\s-]+".join(map(re.escape, re.split(r"[ -]", form))) for form in sorted(forms, key=lambda form: (-len(form), form)))
    heads = "".join(sorted({form[0] for form in forms}))
    untitled = re.compile(rf"(?<!\w)(?=[{heads}])(?:{words})(?!\w)")
    out, at = [], 0
    for e in [*found, (len(text), len(text), "", "", None)]:
        for m in untitled.finditer(text, at, e[0]):
            out.append((m.start(), m.end(), "name", person(m.start(), _plain_name(m.group()), None), None))
        if e[2] == "name":
            e = (*e[:3], person(e[0], e[3], e[4]), e[4])
        out.append(e)
        at = e[1]
    return out[:-1]


def find_entities(text: str) -> list[tuple[int, int, str, str, str | None]]:
    """(start, end, type, canonical form, gender told by a title) of each entity, left to right; only what is to be replaced."""
    out = []
    for kind, start, end in _matches(text):
        found, gender = text[start:end], None
        if kind == "email":
            canonical = found.lower()
        elif kind == "secret":
            start += _SECRET_HEAD.match(found).end()
            if found[-1] in "\"'":
                end -= 1
            canonical = text[start:end]
        elif kind == "iban":
            canonical = found.replace(" ", "")
        elif kind in ("card", "ssn", "phone"):
            canonical = re.sub(r"\D", "", found)
            if kind == "phone":
                canonical = canonical[-10:]  # the national number, however the country is written
        elif kind == "name":
            title, _, name = found.partition(" ")
            name = name.lstrip()
            start = end - len(name)
            canonical, gender = _plain_name(name), _GENDER[title.rstrip(".").lower()]
            gender = None if gender == "n" else gender
        else:
            canonical = found
        if kind in ("secret", "key") and not any(c.isalnum() for c in _KEY_MARKS.sub("", canonical)):
            continue  # masked already
        if start < end:
            out.append((start, end, kind, canonical, gender))
    return _with_untitled(text, out)


# --- surrogates ------------------------------------------------------------------------------------

#: syllables and endings of made-up names, by script
SYLLABLES = {
    "latin": (["ba", "de", "fo", "gi", "ha", "jo", "ka", "le", "mi", "no", "pe", "ra", "su", "ti", "vo", "ze"], {"f": "la", "m": "ran", "n": "rin"}),
    "cyrillic": (["ба", "ве", "го", "ди", "за", "ки", "ло", "ма", "не", "по", "ра", "со", "ти", "фе", "ша", "ян"], {"f": "ла", "m": "тан", "n": "рин"}),
    "greek": (["βα", "γε", "δο", "ζι", "θα", "κο", "λα", "με", "νι", "πο", "ρα", "σε", "τι", "φο", "χα", "ψι"], {"f": "λα", "m": "ραν", "n": "ριν"}),
}


class Stream:
    """Numbers from a keyed hash."""

    def __init__(self, key: bytes, *parts: str):
        self.key, self.seed, self.n, self.buffer = key, "\x1f".join(parts).encode(), 0, b""

    def below(self, n: int) -> int:
        if len(self.buffer) < 8:
            self.buffer += hmac.new(self.key, self.seed + self.n.to_bytes(8, "big"), hashlib.sha256).digest()
            self.n += 1
        value, self.buffer = int.from_bytes(self.buffer[:8], "big"), self.buffer[8:]
        return value % n


def _same_class(c: str, s: Stream) -> str:
    """A character of the same class: digit, or letter of the same case and script; any other stays."""
    if c.isdigit() and c.isascii():
        return str(s.below(10))
    if c.isdecimal():
        return chr(ord(c) - unicodedata.decimal(c) + s.below(10))
    if "a" <= c <= "z":
        return chr(97 + s.below(26))
    if "A" <= c <= "Z":
        return chr(65 + s.below(26))
    if c.isalpha():
        script = unicodedata.name(c, "").split(" ")[0]
        base = {"CYRILLIC": "абвгдежзиклмнопрстуфхцчшэюя", "GREEK": "αβγδεζηθικλμνξοπρστυφχψω", "LATIN": "abcdefghijklmnopqrstuvwxyz"}.get(script)
        if base:
            new = base[s.below(len(base))]
            return new.upper() if c.isupper() else new
        block = ord(c) & ~0x0F
        near = [chr(x) for x in range(block, block + 16) if chr(x).isalpha() and unicodedata.category(chr(x)) == unicodedata.category(c)]
        return near[s.below(len(near))] if near else c
    return c


def _hex_or_class(text: str, s: Stream) -> str:
    if re.fullmatch(r"[0-9a-f]{8,}", text):
        return "".join("0123456789abcdef"[s.below(16)] for _ in text)
    return "".join(_same_class(c, s) for c in text)


def _name(gender: str, script: str, words: int, s: Stream, attempt: int) -> str:
    parts, endings = SYLLABLES[script]
    first = "".join(parts[s.below(16)] for _ in range(2 + attempt // 4)) + endings[gender]
    rest = ["".join(parts[s.below(16)] for _ in range(4)) for _ in range(words - 1)]
    return " ".join([first, *rest])


def script_of(text: str) -> str:
    names = [unicodedata.name(c, "").split(" ")[0].lower() for c in text if c.isalpha()]
    return next((n for n in names if n in SYLLABLES), "latin")


def draw(key: bytes, kind: str, canonical: str, attempt: int) -> str:
    """The canonical form of a surrogate; another for each attempt.  A name comes as ``gender:name``, and gender only picks its ending."""
    gender, _, name = canonical.partition(":") if kind == "name" else ("", "", "")
    canonical = name or canonical
    s = Stream(key, kind, canonical, str(attempt))
    if kind == "email":
        local, _, domain = canonical.rpartition("@")
        labels = domain.split(".")
        d = Stream(key, "domain", domain)  # a domain has one surrogate, whoever writes from it
        return "".join(_same_class(c, s) for c in local) + "@" + ".".join(
            ["".join(_same_class(c, d) for c in x) for x in labels[:-1]] + labels[-1:])
    if kind == "ip":
        a, b, *_ = map(int, canonical.split("."))
        if a == 10 or a == 127:
            head = [a, s.below(256)]
        elif (a, b) in ((192, 168), (169, 254)):
            head = [a, b]
        elif a == 172 and 16 <= b < 32:
            head = [a, 16 + s.below(16)]
        else:
            public = [x for x in range(1, 224) if x not in (10, 100, 127, 169, 172, 192, 198, 203)]
            head = [public[s.below(len(public))], s.below(256)]
        return ".".join(map(str, [*head, s.below(256), 1 + s.below(254)]))
    if kind == "card":
        body = canonical[0] + "".join(str(s.below(10)) for _ in canonical[2:])
        if luhn_sum(canonical) % 10:  # an invalid number gets an invalid one
            return body + str((10 - luhn_sum(body + "0") % 10 + 1 + s.below(9)) % 10)
        return body + str((10 - luhn_sum(body + "0") % 10) % 10)
    if kind == "phone":
        return "".join(str(2 + s.below(8)) if i in (0, 3) else str(s.below(10)) for i in range(len(canonical)))
    if kind == "ssn":
        return f"{1 + s.below(665):03d}{1 + s.below(99):02d}{1 + s.below(9999):04d}"
    if kind == "iban":
        body = "".join(_same_class(c, s) for c in canonical[4:])
        return f"{canonical[:2]}{98 - iban_rest(canonical[:2] + '00' + body):02d}{body}"
    if kind == "name":
        return _name(gender, script_of(name), len(name.split()), s, attempt)
    if kind == "key":
        lines = canonical.split("\n")
        return "\n".join(x if x.startswith("-----") else _hex_or_class(x, s) for x in lines) if len(lines) > 1 else re.sub(
            r"(?<=-----)[^-]+(?=-----END)", lambda m: _hex_or_class(m.group(), s), canonical)
    return _hex_or_class(canonical, s)


def widen(key: bytes, kind: str, canonical: str, attempt: int, wide: int) -> str:
    """A surrogate longer than its entity; ``wide`` (1, 2, ...) makes room for ever more of them."""
    s = Stream(key, "wide", kind, canonical, str(attempt))
    plain = draw(key, kind, canonical, attempt)
    if kind == "name":
        return plain  # grows with the attempt
    if kind == "ip":
        a, b, *_ = map(int, canonical.split("."))
        if wide <= 4 and (a in (10, 127) or (a, b) in ((192, 168), (169, 254)) or a == 172 and 16 <= b < 32):
            return f"10.{s.below(256)}.{s.below(256)}.{1 + s.below(254)}"
        return "fd" + ":".join(["%02x" % s.below(256), *("%04x" % s.below(1 << 16) for _ in range(7))])  # a local IPv6 address
    if kind in ("card", "phone", "ssn"):
        return plain + "".join(str(s.below(10)) for _ in range(20 * wide))
    if kind == "iban":
        body = plain[4:] + "".join(str(s.below(10)) for _ in range(20 * wide))
        return f"{plain[:2]}{98 - iban_rest(plain[:2] + '00' + body):02d}{body}"
    tag = "".join("0123456789abcdef"[s.below(16)] for _ in range(16 * wide))
    if kind == "email":
        local, _, domain = plain.rpartition("@")
        return f"{local}{tag}@{domain}"
    if kind == "key":
        return re.sub(r"(?=-----END)", lambda m: tag + "\n" * ("\n" in plain), plain, count=1)
    return plain + tag


def render(kind: str, mention: str, surrogate: str) -> str:
    """The surrogate in the format of the mention."""
    if kind in ("card", "phone", "ssn", "iban"):
        own = max(0, sum(c.isalnum() for c in mention) - len(surrogate))  # a country code stays
        it = iter([c for c in mention if c.isalnum()][:own] + list(surrogate))
        return "".join(next(it) if c.isalnum() else c for c in mention) + "".join(it)  # a widened one is longer
    if kind == "email":
        return "".join(s.upper() if c.isupper() else s for c, s in zip(mention, surrogate)) if len(mention) == len(surrogate) else surrogate
    if kind == "name":
        words = surrogate.split()
        form = str.upper if mention.isupper() else str.capitalize
        parts = re.split(r"([\s-]+)", mention)  # a bare surname has the last words only
        parts[::2] = [form(w) for w in words[-len(parts[::2]):]]
        return "".join(parts)
    return surrogate


# --- Spark -----------------------------------------------------------------------------------------

_FOUND = f"{ID} long, {ROW} long, at int, until int, kind string, canonical string, gender string, mention string"


def entities(texts: DataFrame) -> DataFrame:
    """One row per mention in (ID, ROW, TEXT) rows."""

    @tidy
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(ID, pa.int64()), (ROW, pa.int64()), ("at", pa.int32()), ("until", pa.int32()),
                            ("kind", pa.string()), ("canonical", pa.string()), ("gender", pa.string()), ("mention", pa.string())])
        for batch in batches:
            for first, part in text_slices(batch.column(2)):
                rows = []
                for i in pc.indices_nonzero(may_hold(part)).to_pylist():
                    text, doc, row = part[i].as_py(), batch.column(0)[first + i].as_py(), batch.column(1)[first + i].as_py()
                    rows += [(doc, row, a, b, k, c, g, text[a:b]) for a, b, k, c, g in find_entities(text)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return texts.mapInArrow(find, _FOUND)


def _per_entity(df: DataFrame, fn: Callable[..., str], columns: list[str], out: str) -> DataFrame:
    """A string column from a function of others, one Arrow batch at a time."""
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.StringType())])

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [fn(*x) for x in zip(*(b.column(c).to_pylist() for c in columns))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(made, pa.string())], [*b.schema.names, out])

    return df.mapInArrow(run, schema)


def distinct_surrogates(mentions: DataFrame, key: bytes, attempts: int = 64) -> DataFrame:
    """(kind, canonical, surrogate) of every distinct entity, all surrogates distinct and none a real entity.

    After ``attempts`` rounds, what is left draws from forms that get longer with each round, so all get one.
    """
    real = mentions.groupBy("kind", "canonical").agg(F.min("gender").alias("least"), F.max("gender").alias("gender"))
    real = real.withColumn("gender", F.when(F.col("least") == F.col("gender"), F.col("gender")).otherwise("n")).drop("least")
    real = real.withColumn("form", F.when(F.col("kind") == "name", F.concat("gender", F.lit(":"), "canonical")).otherwise(F.col("canonical")))
    real = stage(real.drop("gender"), "entities")
    todo, taken = real, None
    for attempt in count():
        drawn = _per_entity(todo, lambda k, c, a=attempt: draw(key, k, c, a) if a < attempts else widen(key, k, c, a, a - attempts + 1),
                            ["kind", "form"], "surrogate")
        drawn = stage(drawn, f"surrogates-{attempt}")
        # one entity wins each surrogate, unless it is a real entity or was won before
        won = drawn.groupBy("kind", "surrogate").agg(F.min("canonical").alias("canonical"))
        won = won.join(real.select("kind", F.col("canonical").alias("surrogate")), ["kind", "surrogate"], "left_anti")
        if taken is not None:
            won = won.join(taken.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        won = stage(won.select("kind", "canonical", "surrogate"), f"won-{attempt}")
        taken = won if taken is None else taken.unionByName(won)
        todo = drawn.drop("surrogate").join(won, ["kind", "canonical"], "left_anti")
        if todo.limit(1).count() == 0:
            return taken


def surrogate_texts(docs: DataFrame, *, key: bytes, id_col: str = "doc_id", text_col: str = "text", attempts: int = 64) -> DataFrame:
    """(ID, ROW, changed text, n_entities, kinds) of the documents that hold entities; all others need no change."""
    texts = keyed_texts(docs, id_col, text_col)
    mentions = stage(entities(texts), "mentions")
    named = distinct_surrogates(mentions, key, attempts)
    # rows that repeat an id and a text have the same mentions: one of each serves
    each = mentions.join(named, ["kind", "canonical"]).groupBy(ID, ROW, "at", "until").agg(
        F.min(F.struct("kind", "mention", "surrogate")).alias("e"))
    changes = each.groupBy(ID, ROW).agg(F.sort_array(F.collect_list(F.struct("at", "until", "e"))).alias("changes"))
    changes = stage(changes, "surrogate-changes").withColumnsRenamed({ID: "__cid", ROW: "__crow"})
    todo = narrowed(texts, ID, changes.select("__cid"))
    todo = todo.join(changes, todo[ID].eqNullSafe(changes["__cid"]) & (todo[ROW] == changes["__crow"])).select(ID, ROW, TEXT, "changes")
    out = f"{ID} long, {ROW} long, {TEXT} string, n_entities long, kinds string"

    @tidy
    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, counts, kinds = [], [], []
            for text, changes in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                parts, at = [], 0
                for c in changes:
                    e = c["e"]
                    parts += [text[at: c["at"]], render(e["kind"], e["mention"], e["surrogate"])]
                    at = c["until"]
                texts.append("".join([*parts, text[at:]]))
                counts.append(len(changes))
                kinds.append(",".join(sorted({c["e"]["kind"] for c in changes})))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(counts, pa.int64()),
                                              pa.array(kinds, pa.string())], [ID, ROW, TEXT, "n_entities", "kinds"])

    # rows that repeat an id and a text give equal rows here, and the join below needs one of them
    return todo.mapInArrow(rewrite, out)


def with_surrogates(docs: DataFrame, *, key: bytes, id_col: str = "doc_id", text_col: str = "text", attempts: int = 64) -> DataFrame:
    """``docs`` with entities replaced in the text column, plus ``n_entities`` and ``kinds``.

    Other columns, whatever their names, are passed through untouched; where ``docs`` has an ``n_entities`` or
    ``kinds`` of its own, the added column has an underscore behind its name.
    """
    n_entities, kinds = (fresh_name(docs.columns, c) for c in ("n_entities", "kinds"))
    own = [f"own_{i}" for i in range(len(docs.columns))]  # so the callers' names meet none of those used here
    low = [c.lower() for c in docs.columns]
    id_at, text_at = own[low.index(id_col.lower())], own[low.index(text_col.lower())]
    docs, names = docs.toDF(*own), docs.columns
    changed = surrogate_texts(docs, key=key, id_col=id_at, text_col=text_at, attempts=attempts)
    changed = stage(changed, "surrogate-texts").dropDuplicates([ID, ROW])
    changed = changed.select(F.col(ID).alias("__cid"), F.col(ROW).alias("__crow"), F.col(TEXT).alias("__new"),
                             F.col("n_entities").alias("__n"), F.col("kinds").alias("__kinds"))
    # a document that certainly has no change stays where it is; the others meet their new texts
    some, none = split_by_keys(docs, id_at, changed.select("__cid"))
    keyed = some.withColumn(ID, F.col(id_at).cast("bigint")).withColumn(ROW, F.coalesce(F.xxhash64(F.col(text_at).cast("string")), F.lit(0)))
    joined = keyed.join(changed, keyed[ID].eqNullSafe(changed["__cid"]) & (keyed[ROW] == changed["__crow"]), "left")
    text = F.coalesce("__new", F.col(text_at).cast("string"))
    out = joined.select(*[text.alias(c) if c == text_at else F.col(c) for c in own],
                        F.coalesce("__n", F.lit(0)).cast("long").alias("n"), F.coalesce("__kinds", F.lit("")).alias("kinds"))
    same = [F.col(c).cast("string").alias(c) if c == text_at else F.col(c) for c in own]
    return out.unionByName(none.select(*same, F.lit(0).cast("long").alias("n"), F.lit("").alias("kinds"))).toDF(*names, n_entities, kinds)
