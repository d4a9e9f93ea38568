"""Personal data replaced by surrogates that keep type, format, gender and script.

A surrogate is drawn from a keyed hash of what it replaces, so an entity has the same one in every text and nobody
without the key can go back. Draws that meet another entity's surrogate, or an entity that occurs, are drawn again in
rounds over the distinct entities; the few redrawn ones go back to their texts, all others are drawn where they stand.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from fleetworks.llm.frames import append, named
from fleetworks.session import settle

#: After so many draws in vain a surrogate may be one character or syllable longer.
WIDEN = 6

# Titles with the gender they tell, and given names by script and gender.
TITLES = {
    "Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Mx": "n", "Herr": "m", "Frau": "f", "Señor": "m", "Señora": "f",
    "Señorita": "f", "Monsieur": "m", "Madame": "f", "Mademoiselle": "f", "Mme": "f", "Mlle": "f", "Doña": "f",
    "господин": "m", "госпожа": "f", "г-н": "m", "г-жа": "f", "κύριος": "m", "κυρία": "f",
}
#: Titles that tell no gender or stand behind another one; they are never part of a name.
RANKS = {
    "Dr": "n", "Doctor": "n", "Doktor": "n", "Prof": "n", "Professor": "n", "Professorin": "f", "Docteur": "n", "Professeur": "n",
    "Doctora": "f", "Profesor": "m", "Profesora": "f", "Sir": "m", "Dame": "f", "Lord": "m", "Lady": "f", "доктор": "n", "профессор": "n",
}
#: Names that are months as well: they are taken behind a title alone.
MONTHS = {"April", "May", "June", "August", "Mai", "Juni", "Juli", "Mars", "Avril", "Juin", "Abril", "Mayo", "Junio", "Julio"}
GIVEN = {
    ("latin", "m"): "Adrian Bruno Conrad Daniel Emil Felix Gregor Henri Ivo Julian Lorenz Marco Nils Oscar Paul Victor",
    ("latin", "f"): "Alma Bianca Clara Diana Elena Flora Greta Helena Ines Julia Laura Maria Nora Olivia Paula Vera",
    ("latin", "n"): "Alex Andrea Charlie Dominique Eden Jamie Jordan Kim Lee Luca Mika Noa Robin Sasha Sidney Toni",
    ("cyrillic", "m"): "Андрей Борис Виктор Григорий Денис Егор Иван Кирилл Лев Максим Николай Олег Павел Роман Семён Тимур",
    ("cyrillic", "f"): "Анна Вера Галина Дарья Елена Жанна Зоя Ирина Кира Лидия Мария Нина Ольга Полина Раиса Софья",
    ("greek", "m"): "Αλέξανδρος Γιώργος Δημήτρης Ιωάννης Κώστας Νίκος Παύλος Πέτρος",
    ("greek", "f"): "Αγγελική Βασιλική Ελένη Ιωάννα Κατερίνα Μαρία Σοφία Χριστίνα",
}
SYLLABLES = {
    "latin": "ba be bel bor da den dor el fa fen ga gar hal ka kel la len lor ma mer na nor pa ral sa sel ta tor va wen",
    "cyrillic": "ба бор ва вел га гор да дор жа ка кар ла лен ма мир на нор па рад са сел та тор ха",
    "greek": "βα γα δα θε κα λα μα να πα ρα σα τα φα χα",
}
#: How family and longer given names end.
ENDINGS = {
    ("latin", "family"): "son ner mann ers ard ini ez", ("latin", "m"): "o in us", ("latin", "f"): "a ia ine",
    ("latin", "n"): "y e is", ("cyrillic", "family-m"): "ов ин ев", ("cyrillic", "family-f"): "ова ина ева",
    ("cyrillic", "family-n"): "енко ко", ("cyrillic", "m"): "ор ан", ("cyrillic", "f"): "а ия",
    ("greek", "family"): "ίδης όπουλος άκης", ("greek", "m"): "ος ης", ("greek", "f"): "α η",
}
#: Letters of scripts without such lists are exchanged for others of the same range.
RANGES = ((0x3041, 0x3096), (0x30A1, 0x30FA), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3), (0x0621, 0x064A), (0x05D0, 0x05EA),
          (0x0905, 0x0939), (0x0561, 0x0586), (0x10D0, 0x10F0), (0x0E01, 0x0E2E))

_EMAIL = re.compile(r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+")
_ADDRESS = re.compile(r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w]|\.\d)")
_PHONE = re.compile(r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\w)")
_ABROAD = re.compile(r"(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\w)")
_SOCIAL = re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")
_CARD = re.compile(r"(?<![\w-])\d(?:[ -]?\d){12,18}(?![\w-])")
_ACCOUNT = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
_ACCESS = re.compile(r"(?<!\w)(?:AKIA|ASIA)[A-Z0-9]{16}(?!\w)")
_SECRET = re.compile(r"(?i)(?<!\w)(?:password|passwd|pwd|secret|token|api[_-]?key)\s*[=:]\s*[\"']?([^\s\"',;]{6,})")
#: Tokens told by how they begin, and blocks that hold a private key.
_TOKEN = re.compile(r"(?<!\w)(?:gh[pousr]_|github_pat_|glpat-|xox[abprs]-|sk_live_|rk_live_|AIza)[A-Za-z0-9_-]{16,}(?![\w-])")
_KEY_BLOCK = re.compile(r"-----BEGIN ([A-Z ]*PRIVATE KEY)-----(.*?)-----END \1-----", re.DOTALL)
_ADDRESS_6 = re.compile(r"(?<![\w:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
                        r"|(?=[0-9A-Fa-f:]*[0-9A-Fa-f]{3})(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\w:]|\.\d)")
#: Networks that are private, and how much of an address of theirs stays.
_PRIVATE = re.compile(r"10\.|127\.|192\.168\.|169\.254\.|172\.(?:1[6-9]|2\d|3[01])\.")
_ANY_TITLE = "|".join(sorted([*TITLES, *RANKS], key=len, reverse=True))
_TITLE = re.compile(rf"(?<!\w)(?:{_ANY_TITLE})\b\.?(?:[ \u00a0](?:{_ANY_TITLE})\b\.?)*")
_ONE_TITLE = re.compile(_ANY_TITLE)
_NAME = re.compile(r"[  ]([^\W\d_](?:[\w]|['’-](?=\w))*)")
_DIGIT = re.compile(r"\d")
#: Country codes: one digit, two digits, else three.
_COUNTRY = re.compile(r"[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3}")


class Draws:
    """An endless stream of numbers from a keyed hash."""

    def __init__(self, key: bytes, *what: str):
        self.seed = hashlib.blake2b("\0".join(what).encode(), key=key, digest_size=32).digest()
        self.pool, self.round = b"", 0

    def below(self, n: int) -> int:
        if len(self.pool) < 8:
            self.pool += hashlib.blake2b(self.round.to_bytes(8, "big"), key=self.seed).digest()
            self.round += 1
        value, self.pool = int.from_bytes(self.pool[:8], "big"), self.pool[8:]
        return value % n

    def of(self, options):
        return options[self.below(len(options))]


def script_of(word: str) -> str:
    """latin, cyrillic, greek or other, by the first letter's name."""
    for c in word:
        if c.isalpha():
            name = unicodedata.name(c, "").split(" ")[0].lower()
            return name if name in SYLLABLES else "other"
    return "other"


def _luhn(digits: str) -> int:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10


def _remainder(account: str) -> int:
    """Modulo 97 of an international account number; 1 if its check digits are right."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97


def _alike(text: str, draws: Draws, hexadecimal: bool = False) -> str:
    """Each character replaced by one of its class; punctuation stays."""
    out = []
    for c in text:
        if c in "0123456789":
            out.append(draws.of("0123456789"))
        elif not c.isalpha():
            out.append(c)
        elif c.isascii():
            letters = "abcdef" if hexadecimal else "abcdefghijklmnopqrstuvwxyz"
            new = draws.of(letters)
            out.append(new.upper() if c.isupper() else new)
        else:
            first, last = next((r for r in RANGES if r[0] <= ord(c) <= r[1]), (ord(c) & ~15, ord(c) | 15))
            same = [x for x in map(chr, range(first, last + 1)) if x.isalpha() and x.isupper() == c.isupper()]
            out.append(draws.of(same))
    return "".join(out)


def _name(kind: str, value: str, attempt: int, draws: Draws) -> str:
    _, part, gender = kind.split("-")
    script = script_of(value)
    if script == "other":
        return _alike(value + value[-1] * (attempt // WIDEN), draws)
    if part == "given" and attempt < WIDEN and (script, gender) in GIVEN:
        return draws.of(GIVEN[script, gender].split()).lower()
    stem = "".join(draws.of(SYLLABLES[script].split()) for _ in range(2 + attempt // WIDEN))
    wanted = [(script, f"family-{gender}"), (script, "family")] if part == "family" else [(script, gender)]
    endings = next((ENDINGS[w] for w in wanted if w in ENDINGS), "")
    return stem + (draws.of(endings.split()) if endings else "")


def phone_parts(shown: str) -> tuple[str, str]:
    """Country code and national number of a mention, as digits. Without a code it is empty."""
    digits = re.sub(r"\D", "", shown)
    code = m[0] if shown[0] == "+" and (m := _COUNTRY.match(digits)) else ""
    return code, digits[len(code):]


def _phone(shown: str) -> str:
    """One entity for all spellings: national digits, behind any country code but 1, which is the one left out."""
    code, national = phone_parts(shown)
    return national if code in ("", "1") else f"+{code} {national}"


def surrogate(key: bytes, kind: str, value: str, attempt: int = 0) -> str:
    """What stands for an entity. ``value`` is the entity as ``mentions`` gives it."""
    draws = Draws(key, kind, value, str(attempt))
    extra = attempt // WIDEN
    if kind.startswith("name-"):
        return _name(kind, value, attempt, draws)
    if kind == "email":
        local, _, host = value.partition("@")
        labels = host.split(".")
        return ".".join([_alike(local + "x" * extra, draws) + "@" + _alike(labels[0], draws),
                         *[_alike(x, draws) for x in labels[1:-1]], labels[-1]])
    if kind == "address-6":
        return _alike(value + value[-1] * extra, draws, hexadecimal=True)
    if kind == "address":
        kept = _PRIVATE.match(value)
        head = kept[0] if kept else ""
        spans = {1: (1, 9), 2: (10, 99), 3: (100, 254)}
        parts = [spans[len(p)] if not extra else (1, 254) for p in value[len(head):].split(".")]
        return head + ".".join(str(a + draws.below(b - a + 1)) for a, b in parts)
    if kind == "phone":
        lead = re.match(r"\+\d+ ", value)
        head = lead[0] if lead else ""
        rest = _alike(value[len(head):] + "0" * extra, draws)
        return head + _DIGIT.sub(lambda m: draws.of("23456789"), rest, count=1)
    if kind in ("card", "number"):
        digits = value[0] + _alike(value[1:] + "0" * extra, draws)
        if kind == "card":
            digits = next(digits[:-1] + d for d in "0123456789" if _luhn(digits[:-1] + d) == 0)
        return digits
    if kind == "access":
        return value[:4] + _alike(value[4:] + "0" * extra, draws)
    if kind == "account":
        if _remainder(value) != 1:
            return value[:2] + _alike(value[2:] + "0" * extra, draws)
        rest = _alike(value[4:] + "0" * extra, draws)
        return f"{value[:2]}{98 - _remainder(value[:2] + '00' + rest):02}{rest}"
    return _alike(value + value[-1] * extra, draws, hexadecimal=kind == "secret-hex")


def _dressed(kind: str, shown: str, new: str) -> str:
    """The surrogate in the mention's upper and lower case and with its blanks and dashes."""
    if kind.startswith("name-"):
        return new.upper() if shown.isupper() and len(shown) > 1 else new[:1].upper() + new[1:] if shown[0].isupper() else new
    if kind in ("email", "address-6"):
        return "".join(b.upper() if a.isupper() else b for a, b in zip(shown, new)) + new[len(shown):]
    if kind == "phone":
        code, _ = phone_parts(shown)
        digits, skip = iter(new.rpartition(" ")[2]), iter(code)
        return re.sub(r"\d", lambda m: next(skip, None) or next(digits), shown) + "".join(digits)
    if kind in ("card", "number", "account"):
        out, at = [], 0
        for c in shown:
            if c in " -":
                out.append(c)
            else:
                out.append(new[at])
                at += 1
        return "".join(out) + new[at:]
    return new


def _found(text: str) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, kind, entity), overlapping ones in order of preference."""
    if "@" in text:
        for m in _EMAIL.finditer(text):
            yield m.start(), m.end(), "email", m[0].lower()
    if "PRIVATE KEY-----" in text:
        for m in _KEY_BLOCK.finditer(text):
            yield m.start(2), m.end(2), "secret", m[2]
    if "_" in text or "-" in text or "AIza" in text:
        for m in _TOKEN.finditer(text):
            at = m.start() + re.match(r"github_pat_|(?:sk|rk)_live_|glpat-|xox.-|gh._|AIza", m[0]).end()
            yield at, m.end(), "secret", text[at:m.end()]
    if text.count(":") > 1:
        for m in _ADDRESS_6.finditer(text):
            yield m.start(), m.end(), "address-6", m[0].lower()
    if "=" in text or ":" in text:
        for m in _SECRET.finditer(text):
            plain = re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", m[1])
            yield m.start(1), m.end(1), "secret-hex" if plain else "secret", m[1]
    if _DIGIT.search(text):
        for m in _ACCESS.finditer(text):
            yield m.start(), m.end(), "access", m[0]
        for m in _ADDRESS.finditer(text):
            if all(int(p) < 256 for p in m[0].split(".")):
                yield m.start(), m.end(), "address", m[0]
        for pattern in (_PHONE, _ABROAD):
            for m in pattern.finditer(text):
                yield m.start(), m.end(), "phone", _phone(m[0])
        for m in _SOCIAL.finditer(text):
            yield m.start(), m.end(), "social", m[0]
        for m in _ACCOUNT.finditer(text):
            yield m.start(), m.end(), "account", m[0].replace(" ", "")
        for m in _CARD.finditer(text):
            digits = re.sub("[ -]", "", m[0])
            yield m.start(), m.end(), "card" if _luhn(digits) == 0 else "number", digits
    known: dict[str, str] = {}
    for m in _TITLE.finditer(text):
        told = [TITLES.get(t) or RANKS[t] for t in _ONE_TITLE.findall(m[0])]
        gender, at, words = next((g for g in told if g != "n"), "n"), m.end(), []
        while len(words) < 3 and (w := _NAME.match(text, at)) and w[1][0].isupper():
            word = re.sub(r"['’]s$", "", w[1])
            words.append((w.start(1), w.start(1) + len(word), word))
            at = w.end()
            if word != w[1]:
                break  # whose name it is, and then what is owned
        for i, (a, b, word) in enumerate(words):
            kind = f"name-{'family' if i == len(words) - 1 else 'given'}-{gender}"
            known.setdefault(word, kind)
            # behind a title of another gender it is another person
            yield a, b, known[word] if known[word].endswith(f"-{gender}") else kind, word.lower()
    for word, kind in known.items():  # the same person without a title
        if len(word) > 2 and word not in MONTHS:
            for m in re.finditer(rf"(?<!\w){re.escape(word)}(?!\w)", text):
                yield m.start(), m.end(), kind, word.lower()


def mentions(text: str | None) -> list[tuple[int, int, str, str]]:
    """Entities of a text in order of place, without overlaps: earlier ones first, then those found first."""
    taken, end = [], 0
    for a, b, kind, value in sorted(_found(text or ""), key=lambda m: m[0]):
        if a >= end:
            taken.append((a, b, kind, value))
            end = b
    return taken


def replace(key: bytes, text: str | None, redrawn: dict[tuple[str, str], int]) -> tuple[str | None, list[dict]]:
    """The text with surrogates, and where these stand in it."""
    found = mentions(text)
    if not found:
        return text, []
    out, spans, at, length = [], [], 0, 0
    for a, b, kind, value in found:
        new = _dressed(kind, text[a:b], surrogate(key, kind, value, redrawn.get((kind, value), 0)))
        out += [text[at:a], new]
        length += a - at + len(new)
        spans.append({"kind": kind, "start": length - len(new), "end": length})
        at = b
    return "".join([*out, text[at:]]), spans


def _entities(docs: DataFrame, text: str) -> DataFrame:
    """(h, kind, value): distinct entities with the hash of the text they stand in."""
    def make():
        return lambda texts, hashes: [[[{"kind": k, "value": v} for k, v in {(m[2], m[3]) for m in mentions(t)}] for t in texts]]

    hashed = docs.select(named(text).alias("_body"), F.xxhash64(named(text)).alias("h"))
    found = append(hashed, "_body", "_found array<struct<kind:string,value:string>>", make, ["h"], ["h"])
    return found.where(F.size("_found") > 0).select("h", F.inline("_found")).distinct()


def redraws(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, value, attempt) of the distinct entities whose first draw would not be theirs alone.

    Every round keeps the draws that no occurring entity and no other draw equals; of equal ones, that with the fewest
    attempts and then the smallest value. The others draw again. Surrogates are compared within names, and within all
    else, since given and family names meet in texts.
    """
    def draw(frame: DataFrame) -> DataFrame:
        def make():
            return lambda values, kinds, attempts: [
                [surrogate(key, k, v, n) for v, k, n in zip(values, kinds, attempts)]]

        drawn = append(frame, "value", "drawn string", make, ["kind", "value", "attempt"], ["kind", "attempt"])
        return drawn.withColumn("field", F.when(F.col("kind").startswith("name-"), "name").otherwise("other"))

    occurring = entities.select(
        F.when(F.col("kind").startswith("name-"), "name").otherwise("other").alias("field"), F.col("value").alias("drawn")).distinct()
    state = settle(draw(entities.withColumn("attempt", F.lit(0))), "draws")
    while True:
        best = state.groupBy("field", "drawn").agg(F.min(F.struct("attempt", "kind", "value")).alias("best"), F.count("*").alias("n"))
        # only draws that meet another or an entity go on
        lost = (
            best.join(occurring.withColumn("taken", F.lit(True)), ["field", "drawn"], "left")
            .where("n > 1 or taken").select("field", "drawn", "best", F.coalesce("taken", F.lit(False)).alias("taken"))
        )
        judged = state.join(lost, ["field", "drawn"], "left").withColumn(
            "again", F.coalesce(F.col("taken") | (F.struct("attempt", "kind", "value") != F.col("best")), F.lit(False)))
        judged = settle(judged.select("kind", "value", "attempt", "drawn", "field", "again"), "judged")
        if judged.where("again").isEmpty():
            return state.where("attempt > 0").select("kind", "value", "attempt")
        moved = draw(judged.where("again").select("kind", "value", (F.col("attempt") + 1).alias("attempt")))
        state = settle(judged.where("not again").select(*state.columns).unionByName(moved), "draws")


def anonymize(docs: DataFrame, key: bytes, text: str = "text", keep=None) -> DataFrame:
    """``docs`` with surrogates in ``text``, ``n_entities``, ``kinds`` (sorted, comma-joined) and ``entities``.

    ``entities`` holds kind, start and end of each surrogate in the new text; what it replaced is in no column. Equal
    entities have equal surrogates in all texts and different ones differ, and no surrogate is an entity of its field
    that occurs. A person's name is found behind a title, and from then on in that whole text. Null texts stay null and
    empty ones empty, with no entities; texts without entities are unchanged. Repeated rows stay alike; clashing
    columns are replaced; an empty table stays empty.
    """
    entities = settle(_entities(docs, text), "entities")
    again = redraws(entities.select("kind", "value").distinct(), key)
    by_text = settle(
        entities.join(again, ["kind", "value"]).groupBy("h").agg(F.collect_set(F.struct("kind", "value", "attempt")).alias("_again")),
        "redraws")
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ("n_entities", "kinds", "entities")]
    ready = docs.select(*[named(c) for c in kept if c != text], named(text).alias("_body"), F.xxhash64(named(text)).alias("h")).join(
        by_text, "h", "left")

    def make():
        def work(texts, lists):
            rows = [replace(key, t, {(r["kind"], r["value"]): r["attempt"] for r in again or ()}) for t, again in zip(texts, lists)]
            return ([t for t, _ in rows], [len(s) for _, s in rows],
                    [",".join(sorted({x["kind"] for x in s})) for _, s in rows], [s for _, s in rows])
        return work

    done = append(ready, "_body", f"`{text}` string, n_entities bigint, kinds string, "
                  "entities array<struct<kind:string,start:bigint,end:bigint>>", make, [c for c in kept if c != text], ["_again"])
    return done.select(*[named(c) for c in [*kept, *([] if text in kept else [text])]], "n_entities", "kinds", "entities")
