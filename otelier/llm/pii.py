"""Personal data replaced by surrogates of the same type and look.

An entity is a kind and a canonical value (digits of a phone number, lower-case address, one part of a name). Its
surrogate depends on a keyed hash of both and on the shape of the value, so every mention in every document gets the
same one, written the way the mention was. Digits stay digits, letters stay letters of the same case, check digits are
right again, names keep script and gender. All entities of the corpus are compared once: where two surrogates are
equal, or one equals a real value, the later entity takes the next attempt of its keyed sequence. Every second attempt
widens the shape, so a format that has fewer surrogates than the corpus has values can't be used up, and the number of
rounds grows with the logarithm of the entities only. Tables between the jobs hold keyed hashes and shapes, no values.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import secrets
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from otelier.llm.memo import once
from otelier.llm.staging import staged

#: Titles and first names that show gender, by script.
TITLES = {"m": ("Mr", "Herr", "Monsieur", "Señor", "Господин"), "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Señora", "Госпожа"),
          "n": ("Dr", "Prof")}
FIRST_NAMES = {
    ("latin", "m"): ("Alexander", "Andrew", "Charles", "Christopher", "Daniel", "David", "Edward", "Frederick", "Henry", "James",
                     "Jonathan", "Matthew", "Michael", "Nicholas", "Patrick", "Richard", "Robert", "Stephen", "Thomas", "William"),
    ("latin", "f"): ("Alexandra", "Barbara", "Caroline", "Catherine", "Charlotte", "Deborah", "Elizabeth", "Florence", "Jennifer",
                     "Jessica", "Margaret", "Michelle", "Patricia", "Rebecca", "Samantha", "Stephanie", "Susan", "Veronica",
                     "Victoria", "Virginia"),
    ("cyrillic", "m"): ("Александр", "Алексей", "Андрей", "Борис", "Виктор", "Дмитрий", "Иван", "Михаил", "Николай", "Сергей"),
    ("cyrillic", "f"): ("Александра", "Анна", "Валентина", "Екатерина", "Елена", "Мария", "Наталья", "Ольга", "Светлана", "Татьяна"),
}
#: First names that surrogates are drawn from; none of them is in the list above.
SURROGATE_NAMES = {
    ("latin", "m"): ("Adrian", "Bernard", "Clement", "Dominic", "Edmund", "Felix", "Gregory", "Harold", "Isaac", "Julian",
                     "Kenneth", "Leonard", "Martin", "Norman", "Oliver", "Philip", "Raymond", "Samuel", "Theodore", "Vincent"),
    ("latin", "f"): ("Adele", "Beatrice", "Clara", "Diana", "Eleanor", "Frances", "Gloria", "Helena", "Irene", "Judith",
                     "Katherine", "Lydia", "Miriam", "Nora", "Olivia", "Pauline", "Rosalind", "Sylvia", "Theresa", "Yvonne"),
    ("cyrillic", "m"): ("Антон", "Вадим", "Георгий", "Денис", "Егор", "Кирилл", "Леонид", "Максим", "Павел", "Тимофей"),
    ("cyrillic", "f"): ("Алина", "Вера", "Галина", "Дарья", "Жанна", "Ксения", "Людмила", "Марина", "Полина", "Юлия"),
}
_SYLLABLES = {"latin": ("bar", "cor", "del", "fen", "gar", "hol", "jin", "kem", "lor", "mar", "nor", "pel", "ras", "sel", "tor", "ven"),
              "cyrillic": ("бар", "вол", "гор", "дан", "жел", "зор", "кам", "лаз", "мир", "нов", "пет", "рог", "сав", "тар", "фом", "шер")}
_ENDINGS = {("latin", "m"): "son", ("latin", "f"): "son", ("cyrillic", "m"): "ов", ("cyrillic", "f"): "ова"}

_WORD = {"latin": "[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]{2,}", "cyrillic": "[А-ЯЁ][а-яё]{2,}"}
_ANY = f"(?:{_WORD['latin']}|{_WORD['cyrillic']})"
_TITLE_GENDER = {t: g for g, ts in TITLES.items() for t in ts}
_NAME_GENDER = {n: g for (_, g), ns in FIRST_NAMES.items() for n in ns}
#: What a text with a name holds; looking for these first saves most texts the slower patterns.
_SHOWN = (*_TITLE_GENDER, *_NAME_GENDER)
_TITLED = re.compile(rf"\b({'|'.join(_TITLE_GENDER)})\.?[ \t]({_ANY})(?:[ \t]({_ANY}))?")
_NAMED = re.compile(rf"\b({'|'.join(_NAME_GENDER)})[ \t]({_ANY})\b")

_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}")
_IPV4 = re.compile(r"(?a)(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?!\d|\.\d)")
#: Digits that a card number can be a part of; other numbers may stand before and after it.
_DIGIT_RUN = re.compile(r"(?a)(?<![\d+])\d(?:[ -]?\d){12,}(?!\d)")
#: How issuers begin their numbers, by length.
_ISSUED = re.compile(r"4(?:\d{12}|\d{15}|\d{18})|(?:5[1-5]|2[2-7])\d{14}|3[47]\d{13}|3[0689]\d{12}|6\d{15,18}|35\d{14}")
_PHONE = re.compile(r"(?a)(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<![\w+])\(?\d{3}\)?[ .-]\d{3}[.-]\d{4}(?!\d)")
_SSN = re.compile(r"(?a)(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])")
_IBAN = re.compile(r"(?a)\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")
_IBAN_START = re.compile(r"(?a)\b[A-Z]{2}\d{2}(?= ?[A-Z0-9]{4})")
#: Characters of an IBAN by country, where known.
_IBAN_LENGTH = {c: int(n) for n, cs in (x.split(":") for x in (
    "15:NO 16:BE 18:DK,FI,FO,GL,NL,FK,SD 19:MK,SI 20:AT,BA,EE,KZ,LT,LU,XK,MN 21:CH,HR,LI,LV 22:BG,BH,CR,DE,GB,GE,IE,ME,RS,VA "
    "23:AE,GI,IL,IQ,OM,TL,SO 24:AD,CZ,ES,MD,PK,RO,SA,SE,SK,TN,VG 25:LY,PT,ST 26:IS,TR 27:BI,DJ,FR,GR,IT,MC,MR,SM "
    "28:AL,AZ,BY,CY,DO,GT,HU,LB,NI,PL,SV 29:BR,EG,PS,QA,UA 30:JO,KW,MU,YE 31:MT,SC 32:LC 33:RU").split()) for c in cs.split(",")}
_IBAN_OF = {n: re.compile(rf"(?a)[A-Z]{{2}}\d{{2}}(?: ?[A-Z0-9]{{4}}){{{(n - 4) // 4}}}{f' ?[A-Z0-9]{{{n % 4}}}' if n % 4 else ''}\b") for n in range(12, 36)}
_CLOUD_KEY = re.compile(r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b")
_DIGIT = re.compile("[0-9]")
_CHANGES = re.compile("[0-9A-Za-z]")
_SECRET_WORDS = ("passw", "pwd", "secret", "token", "key")
_SECRET = re.compile(r"(?i)\b(?:password|passwd|pwd|secret|token|api[_-]?key)[\"']?[ \t]*[=:][ \t]*[\"']?([A-Za-z0-9_/+.-]{8,})")


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(2 * int(d) - 9 * (d > "4") for d in digits[-2::-2])
    return total % 10 == 0


def iban_remainder(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def _script(word: str) -> str:
    return "cyrillic" if "Ѐ" <= word[0] <= "ӿ" else "latin"


def _find_cards(text: str) -> Iterator[tuple[int, int, str, str]]:
    """Card numbers that an issuer could have given and that begin and end where groups of digits do; the earlier and
    the longer ones come first."""
    for run in _DIGIT_RUN.finditer(text):
        groups = [(m.start(), m.end()) for m in re.finditer("[0-9]+", run[0])]
        valid = []
        for i, (start, _) in enumerate(groups):
            length = 0
            for a, end in groups[i:]:
                length += end - a
                if length > 19:
                    break
                if length >= 13 and luhn(value := _digits(run[0][start:end])) and _ISSUED.fullmatch(value):
                    valid.append((start, -end, value))
        taken = bytearray(len(run[0]))
        for start, end, value in sorted(valid):
            if not any(taken[start:-end]):
                taken[start:-end] = b"\1" * (-end - start)
                yield run.start() + start, run.start() - end, "card", value


def _find_ibans(text: str) -> Iterator[tuple[int, int, str, str]]:
    """IBAN by the length of the country; otherwise by the longest match, or for unknown countries any end of a word."""
    at = 0
    for m in _IBAN_START.finditer(text):
        start = m.start()
        if start < at:
            continue
        known = _IBAN_LENGTH.get(m[0][:2])
        ends = [e for e in (_IBAN_OF[n].match(text, start) for n in ([known] if known else range(35, 11, -1))) if e]
        if known and (longest := _IBAN.match(text, start)):
            ends.append(longest)
        for e in ends:
            value = e[0].replace(" ", "")
            if iban_remainder(value) == 1:
                yield start, e.end(), "iban", value
                at = e.end()
                break


def find_entities(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical value) of the entities of a text, in order and apart. What has no letter or digit that
    a surrogate could change is none."""
    found: list[tuple[int, int, str, str]] = []
    if "@" in text:
        found += [(*m.span(), "email", m[0].lower()) for m in _EMAIL.finditer(text) if _CHANGES.search(m[0].rpartition(".")[0])]
    lower = text.lower()
    if any(word in lower for word in _SECRET_WORDS):
        found += [(*m.span(1), "secret", m[1]) for m in _SECRET.finditer(text) if _CHANGES.search(m[1])]
    if _DIGIT.search(text):
        if "KIA" in text or "SIA" in text:
            found += [(*m.span(), "cloud-key", m[0]) for m in _CLOUD_KEY.finditer(text)]
        found += _find_cards(text)
        found += _find_ibans(text)
        found += [(*m.span(), "phone", _national(m[0])) for m in _PHONE.finditer(text)]
        found += [(*m.span(), "ssn", _digits(m[0])) for m in _SSN.finditer(text)]
        found += [(*m.span(), "ip", m[0]) for m in _IPV4.finditer(text)]
    if any(name in text for name in _SHOWN):
        found += _find_names(text)
    out, end = [], 0
    for e in sorted(found, key=lambda e: (e[0], -e[1])):  # at one place the longest counts
        if e[0] >= end:
            out.append(e)
            end = e[1]
    return out


def _find_names(text: str) -> list[tuple[int, int, str, str]]:
    found, surnames = [], {}
    for m in _TITLED.finditer(text):
        first = m[2] if m[2] in _NAME_GENDER else None
        gender = _NAME_GENDER.get(m[2]) or _TITLE_GENDER[m[1]]
        last = 3 if m[3] and (first or m[3][0].isupper()) else 2
        if last == 3:
            found.append((*m.span(2), f"first-{_script(m[2])}-{gender if gender != 'n' else 'm'}", m[2]))
        if last == 3 or not first:
            surnames[m[last]] = gender
            found.append((*m.span(last), f"last-{_script(m[last])}", m[last]))
    for m in _NAMED.finditer(text):
        found.append((*m.span(1), f"first-{_script(m[1])}-{_NAME_GENDER[m[1]]}", m[1]))
        found.append((*m.span(2), f"last-{_script(m[2])}", m[2]))
        surnames[m[2]] = _NAME_GENDER[m[1]]
    for name in surnames:  # later mentions by the surname alone
        found += [(*m.span(), f"last-{_script(name)}", name) for m in re.finditer(rf"\b{re.escape(name)}\b", text)]
    return found


def _national(phone: str) -> str:
    digits = _digits(phone)
    return digits[1:] if len(digits) == 11 and digits[0] == "1" else digits


def entity_id(key: bytes, kind: str, value: str) -> bytes:
    """Stands for an entity outside its text: 16 bytes that only the key can connect with the value."""
    return hmac.new(key, f"{kind}\0{value}".encode("utf-8", "surrogatepass"), hashlib.sha256).digest()[:16]


def _stream(key: bytes, entity: bytes, attempt: int) -> Iterator[int]:
    """Pseudo-random bytes that depend on the secret key and the entity."""
    n = 0
    while True:
        yield from hmac.new(key, entity + attempt.to_bytes(4, "big") + n.to_bytes(4, "big"), hashlib.sha256).digest()
        n += 1


_BLANKED = str.maketrans("123456789" + "bcdefghijklmnopqrstuvwxyz" + "BCDEFGHIJKLMNOPQRSTUVWXYZ", "0" * 9 + "a" * 25 + "A" * 25)


def shape(kind: str, value: str) -> str:
    """What a surrogate keeps of a value: digits become 0, letters a or A. The top domain of an address, the first digit of
    a card, the country of an IBAN and the prefix of a cloud key stay; of names only what shows gender does."""
    if kind == "email":
        body, _, top = value.rpartition(".")
        return f"{body.translate(_BLANKED)}.{top}"
    if kind in ("card", "iban", "cloud-key"):
        kept = {"card": 1, "iban": 2, "cloud-key": 4}[kind]
        return value[:kept] + value[kept:].translate(_BLANKED)
    if kind == "secret" and re.fullmatch("[0-9a-f]+", value):
        return "#" * len(value)
    if kind.startswith(("first-", "last-")):
        return "f" if "cyrillic" in kind and value.endswith(("а", "я")) else "m"
    return value.translate(_BLANKED)


def _filled(mask: str, more: Iterator[int]) -> str:
    out = []
    for c in mask:
        if c == "0":
            out.append("0123456789"[next(more) % 10])
        elif c == "#":
            out.append("0123456789abcdef"[next(more) % 16])
        elif c in "aA":
            out.append(chr(ord(c) + next(more) % 26))
        else:
            out.append(c)
    return "".join(out)


def _octet(digits: int, wider: int, more: Iterator[int]) -> str:
    """A part of an address with as many digits as the real one; wider ones have more, in the end beyond what is real."""
    low, high = [(1, 9), (10, 99), (100, 255), (256, 999), (1000, 9999)][min(digits - 1 + wider, 4)]
    return str(low + (next(more) << 16 | next(more) << 8 | next(more)) % (high - low + 1))


def made(key: bytes, kind: str, entity: bytes, mask: str, attempt: int) -> str:
    """The canonical surrogate of an entity at some attempt. Every second attempt adds a character (or an octet digit)."""
    more, wider = _stream(key, entity, attempt), attempt // 2
    if kind == "email":
        body, _, top = mask.rpartition(".")
        name, _, host = body.partition("@")
        return f"{_filled(name + 'a' * wider, more)}@{_filled(host, more)}.{top}"
    if kind == "ip":
        return ".".join(_octet(len(p), wider, more) for p in mask.split("."))
    if kind == "card":
        body = mask[0] + _filled(mask[1:-1] + "0" * wider, more)
        return next(body + d for d in "0123456789" if luhn(body + d))
    if kind == "iban":
        body = _filled(mask[4:] + "0" * wider, more)
        return f"{mask[:2]}{98 - iban_remainder(mask[:2] + '00' + body):02d}{body}"
    if kind == "phone" and len(mask) >= 10:
        return _filled(mask[:-10], more) + str(2 + next(more) % 8) + _filled(mask[-9:] + "0" * wider, more)
    if kind in ("phone", "ssn"):
        return _filled(mask + "0" * wider, more)
    if kind == "cloud-key":
        return mask[:4] + _filled(mask[4:] + "A" * wider, more)
    if kind == "secret":
        return _filled(mask + ("#" if "#" in mask else "a") * wider, more)
    part, script, *gender = kind.split("-")
    if part == "first":
        names = SURROGATE_NAMES[script, gender[0]]
        name = names[(next(more) << 8 | next(more)) % len(names)]
        # the list is short: later attempts make new names in the same way
        return name if not attempt else name + "".join(_SYLLABLES[script][next(more) % 16] for _ in range(1 + wider))
    return "".join(_SYLLABLES[script][next(more) % 16] for _ in range(4 + wider)).capitalize() + _ENDINGS[script, mask]


def surrogate(key: bytes, kind: str, value: str, attempt: int = 0) -> str:
    """The canonical surrogate of a value."""
    return made(key, kind, entity_id(key, kind, value), shape(kind, value), attempt)


def written(kind: str, mention: str, canonical: str) -> str:
    """The surrogate in the format of the mention; what a widened one has more comes at its end."""
    if kind in ("card", "phone", "ssn", "iban"):
        keep = (lambda c: c.isalnum()) if kind == "iban" else (lambda c: "0" <= c <= "9")
        places = [i for i, c in enumerate(mention) if keep(c)][-len(canonical):]
        out = list(mention)
        for i, c in zip(places, canonical):
            out[i] = c
        last = places[-1] + 1
        return "".join(out[:last]) + canonical[len(places):] + "".join(out[last:])
    if kind == "email":
        if mention.isupper():
            return canonical.upper()
        # the case of each letter, part by part
        (a, _, b), (x, _, y) = mention.rpartition("@"), canonical.rpartition("@")
        case = lambda old, new: "".join(n.upper() if o.isupper() else n for o, n in zip(old, new)) + new[len(old):]
        return f"{case(a, x)}@{case(b, y)}"
    return canonical


def replace_entities(text: str, of: Callable[[str, str], str]) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with surrogates, and (kind, start, end) of each in the new text. `of(kind, value)` gives surrogates."""
    out, spans, at, length = [], [], 0, 0
    for start, end, kind, value in find_entities(text):
        new = written(kind, text[start:end], of(kind, value))
        out += [text[at:start], new]
        length += start - at
        spans.append((kind, length, length + len(new)))
        length += len(new)
        at = end
    return "".join([*out, text[at:]]), spans


def secret_key(spark: SparkSession) -> bytes:
    """The key in the session's `spark.otelier.pii.key`. Without it a random one is made for this application, so surrogates
    agree within it and differ from run to run; nobody else can connect them with values."""
    given = spark.conf.get("spark.otelier.pii.key", None)
    return given.encode() if given else once(("pii key", spark.sparkContext.applicationId), lambda: secrets.token_bytes(32))


def _retried(key: bytes, entities: DataFrame) -> DataFrame:
    """(kind, id, attempt) of the entities (kind, id, mask, made) that can't take attempt 0; `id` and `made` are keyed hashes of
    the value and of the surrogate."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b = b.copy()
            b["made"] = [entity_id(key, k, made(key, k, bytes(i), m, a)) for k, i, m, a in zip(b["kind"], b["id"], b["mask"], b["attempt"])]
            yield b

    schema = "kind string, id binary, mask string, attempt int, made binary"
    state = entities.select("kind", "id", "mask", F.lit(0).alias("attempt"), "made")
    while True:
        # who came first keeps a surrogate; nobody keeps one that is a real value of that kind
        ranked = state.withColumn("rank", F.row_number().over(Window.partitionBy("kind", "made").orderBy("attempt", "id")))
        real = entities.select("kind", F.col("id").alias("made"), F.lit(True).alias("real"))
        judged = staged(ranked.join(real, ["kind", "made"], "left").withColumn("again", F.expr("rank > 1 OR real IS NOT NULL")), "judged")
        if judged.where("again").isEmpty():
            return judged.where("attempt > 0").select("kind", "id", "attempt")
        again = judged.where("again").select("kind", "id", "mask", (F.col("attempt") + 1).alias("attempt"), "made").mapInPandas(run, schema)
        state = judged.where("NOT again").select("kind", "id", "mask", "attempt", "made").unionAll(again)


def _row_key(text: Column) -> Column:
    return F.xxhash64(text)


def anonymise(docs: DataFrame, secret: bytes, text: str = "text") -> DataFrame:
    """`docs` with `text` replaced, plus `entities`: array of (kind, start, end) in the new text.

    `secret` keys the surrogates; keep it out of the data. Null text stays null with no entities; text without entities
    is unchanged. Equal entities get equal surrogates and different ones different surrogates across all rows, also in
    repeated rows. All other columns pass through, except one named `entities`, which is replaced. An empty table gives
    an empty one. Very long texts are held whole, one at a time. First names with a doctor's title and no known gender
    are treated as male. A surrogate is longer than the value where its format has too few values for the corpus. What
    is staged holds keyed hashes; remove it when the result is written.
    """
    rows = docs.drop("entities")

    def detect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = {(k, v, h) for h, t in zip(batch["h"], batch["t"]) for _, _, k, v in find_entities(t)}
            rows = []
            for k, v, h in found:
                i, mask = entity_id(secret, k, v), shape(k, v)
                rows.append((k, i, mask, entity_id(secret, k, made(secret, k, i, mask, 0)), h))
            yield pd.DataFrame(rows, columns=["kind", "id", "mask", "made", "h"])

    source = rows.where(F.col(text).isNotNull()).select(_row_key(F.col(text)).alias("h"), F.col(text).alias("t"))
    mentions = staged(source.mapInPandas(detect, "kind string, id binary, mask string, made binary, h bigint"), "mentions")
    retried = staged(_retried(secret, mentions.select("kind", "id", "mask", "made").distinct()), "retried")

    names = rows.columns
    place = names.index(text)
    if retried.isEmpty():
        with_retries = rows.withColumn("__retried", F.lit(None).cast("array<struct<id:binary,attempt:int>>"))
    else:
        # only texts that hold an entity with a later attempt have something to look up
        needed = mentions.join(retried, ["kind", "id"]).groupBy("h").agg(F.collect_set(F.struct("id", "attempt")).alias("__retried"))
        with_retries = rows.join(needed, _row_key(F.col(text)) == F.col("h"), "left").drop("h")

    @F.pandas_udf("text string, entities array<struct<kind:string,start:int,end:int>>")
    def replaced(t: pd.Series, later: pd.Series) -> pd.DataFrame:
        out = []
        for x, l in zip(t, later):
            if x is None:
                out.append((None, []))
                continue
            attempts = {bytes(e["id"]): e["attempt"] for e in l} if l is not None else {}

            def of(kind: str, value: str) -> str:
                entity = entity_id(secret, kind, value)
                return made(secret, kind, entity, shape(kind, value), attempts.get(entity, 0))

            new, spans = replace_entities(x, of)
            out.append((new, [{"kind": k, "start": a, "end": b} for k, a, b in spans]))
        return pd.DataFrame(out, columns=["text", "entities"])

    done = with_retries.withColumn("__done", replaced(F.col(text), F.col("__retried")))
    return done.select(*[F.col("__done.text").alias(c) if i == place else F.col(c) for i, c in enumerate(names)],
                       F.col("__done.entities").alias("entities"))
