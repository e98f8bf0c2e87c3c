"""Personal data by weak supervision.

Wide patterns propose spans; labelers vote on each, for (1), against (-1) or not at all (0): its checksum
or form, gazetteers, the words before it, and how it is set off from its surroundings. Spark counts the
vote patterns of each kind over all documents; expectation-maximisation over these counts, of which there
are at most kinds x 3^labelers whatever the input, estimates how reliable each labeler is. Its posteriors
are the soft labels of the final classifier, a logistic regression per kind on what the labelers don't see:
the words around the span, the signs at its ends, its shape and its length, beside the votes. It is fitted on
a bounded sample, TRAIN_SPANS of each kind, by hash, and judges all spans. Spans of the four base kinds
always stay; the classifier decides the others.

Proposals are made in one pass over whole texts and stored with their features, so that the second pass
reads spans, not texts. What reaches the driver is the table of pattern counts and the sample.

Limits of the added kinds: the parts of a written-out address have 64, 63 and 24 signs at most, as mail and
DNS allow; a name has two words of 31 letters at most after its title.

Cases: null counts as empty text; a text of any length is searched in linear time; repeated rows are
searched each; an empty table gives no rows and trains nothing; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from twinfold.llm.shared import stored

#: The base kinds in the contract's order, then those that the method adds.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "written_email", "local_phone", "ssn", "iban", "name")
LABELERS = ("form", "gazetteer", "context", "setting")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
WRITTEN_EMAIL = re.compile(r"\b[A-Za-z0-9._%+-]{1,64} ?(?:\[at\]|\(at\)| at ) ?[A-Za-z0-9-]{1,63} ?(?:\[dot\]|\(dot\)| dot ) ?[A-Za-z]{2,24}\b")
LOCAL_PHONE = re.compile(r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?![0-9.-])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
IBAN = re.compile(r"(?<![A-Z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Z0-9])")
NAME = re.compile(r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Mme|Señor|Señora|Sra|Sr)\b\.? [A-Z][a-zà-ÿ]{1,30}(?: [A-Z][a-zà-ÿ]{1,30})?")

# Gazetteers.
TLDS = frozenset(
    "com org net edu gov mil int info biz name io co ai app dev me tv cc eu ac ad ae af al am ar at au az ba bd be bg bh bo br by ca ch ci cl cm cn cr cu cy cz de dk do dz ec ee eg es fi fr ge gh gr gt hk hn hr hu id ie il in iq ir is it jm jo jp ke kh kr kw kz lb lk lt lu lv ly ma md mk mm mn mt mx my ng ni nl no np nz om pa pe ph pk pl pt py qa ro rs ru sa se sg si sk sn sv sy th tn tr tt tw ua ug uk us uy uz ve vn ye za zm zw example test".split()
)
DIAL_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98 212 213 216 218 220 221 225 230 233 234 251 254 255 256 351 352 353 354 355 356 357 358 359 370 371 372 373 374 375 380 381 385 386 387 389 420 421 502 503 504 505 506 507 591 593 595 598 852 855 880 886 960 961 962 963 964 965 966 971 972 974 976 977 992 993 994 995 996 998".split())
CARD_STARTS = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65", "35", "2")
IBAN_LENGTHS = {"AD": 24, "AE": 23, "AL": 28, "AT": 20, "BA": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "RS": 22, "SE": 24, "SI": 19, "SK": 24, "TR": 26}
FIRST_NAMES = frozenset(
    "adam alan albert alejandro alex alexander alice amanda amy ana andrea andreas andrew angela anita anna anne anthony antonio arthur barbara benjamin bernard bernd betty brian bruno carlos carmen caroline catherine cecilia charles charlotte christian christine claire clara claude claudia claus cristina daniel david deborah diana diego dieter dominique donald dorothy eduardo edward elena elizabeth emily emma eric erik ernst eva felix fernando florian francis francisco frank franz françois frederic gabriel georg george gerhard gisela gloria grace gustavo hannah hans harald heidi heinz helen helga henri henry hugo ines ingrid irene isabel jack jacques james jan jane jean jennifer jessica joan johann john jonas jorge jose joseph josé juan judith julia julie jürgen karen karin karl katharina kevin klaus laura lena leon linda lisa louis louise lucas lucia luis manuel marco margaret maria marie mario mark marta martin martina mary matthew max mercedes michael michel miguel monica monika nancy natalie nicolas nicole noah olga oliver pablo pascal patricia paul pedro peter petra philip pierre pilar rachel rafael ralf raul rebecca richard robert roberto rosa ruth sabine samuel sandra sara sarah sebastian sergio simon sofia sophie stefan stephen susan sven sylvie teresa theresa thomas timothy tobias ulrike ursula valentin victor victoria walter werner william wolfgang yvonne".split()
)
#: Words before a span that speak for its kind; a star stands for any ending.
CUES = {
    "email": "mail e-mail email emails mailto contact write reach kontakt* correo courriel address", "written_email": "mail e-mail email contact write reach kontakt* correo courriel address",
    "ip": "ip ipv4 host server address from login node gateway adresse", "card": "card cards visa mastercard amex credit debit karte kreditkarte tarjeta carte",
    "phone": "phone telephone tel call fax mobile cell whatsapp telefon* teléfono téléphone", "local_phone": "phone telephone tel call fax mobile cell whatsapp telefon* teléfono téléphone",
    "ssn": "ssn social security tax taxpayer", "iban": "iban account konto bank cuenta compte transfer", "name": "dear by name named from contact signed author liebe* lieber sehr estimad* cher chère",
}
COUNTER_CUES = "version v release order isbn issn page figure table article invoice sku build no part model serial section chapter"
CUE_WINDOW, CUE_WORDS = 40, 4
WORDS = re.compile(r"[^\W_]+(?:-[^\W_]+)*")

#: Spans of each kind that the classifier is fitted on, at most, and the slots of its hashed features.
TRAIN_SPANS, SLOTS = 1000, 1 << 12


def _cue_pattern(words: str) -> re.Pattern:
    return re.compile("(?:" + "|".join(re.escape(w[:-1]) + ".*" if w.endswith("*") else re.escape(w) for w in words.split()) + ")")


CUE_PATTERNS = {kind: _cue_pattern(words) for kind, words in CUES.items()}
COUNTER_PATTERN = _cue_pattern(COUNTER_CUES)


def luhn(digits: str) -> bool:
    total = 0
    for k, x in enumerate(reversed(digits)):
        d = ord(x) - 48
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each match has one "@": its local part reaches back as far as it can, its domain forward."""
    at, last = text.find("@"), 0
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            last = m.end()
        else:
            last = at + 1
        at = text.find("@", last)


def small(part: str) -> bool:
    part = part.lstrip("0") or "0"
    return len(part) <= 3 and int(part) <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base kinds, by kind and start."""
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    out += [(1, *m.span()) for m in IP.finditer(text) if all(map(small, m[0].split(".")))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *m.span()))
    if "+" in text:
        out += [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= sum(x.isdigit() for x in m[0]) <= 15]
    return out


def more_spans(text: str) -> list[tuple[int, int, int]]:
    """Proposals of the further kinds."""
    out = []
    lower_at = " at " in text or "at]" in text or "at)" in text
    if lower_at and (" dot " in text or "dot]" in text or "dot)" in text):
        out += [(4, *m.span()) for m in WRITTEN_EMAIL.finditer(text)]
    for kind, pattern in ((5, LOCAL_PHONE), (6, SSN), (7, IBAN), (8, NAME)):
        out += [(kind, *m.span()) for m in pattern.finditer(text)]
    return out


def iban_valid(value: str) -> bool:
    value = value.replace(" ", "")
    return 15 <= len(value) <= 34 and int("".join(str(int(x, 36)) for x in value[4:] + value[:4])) % 97 == 1


def words_before(text: str, start: int) -> list[str]:
    """The last words before a span, nearest first; the first one in reach may be cut."""
    return [m[0] for m in WORDS.finditer(text[max(0, start - CUE_WINDOW) : start].lower())][: -CUE_WORDS - 1 : -1]


def vote(text: str, kind: int, start: int, end: int) -> list[int]:
    """The labelers' votes on one span."""
    name, value = KINDS[kind], text[start:end]
    digits = "".join(x for x in value if "0" <= x <= "9")
    if name in ("email", "written_email"):
        tld = re.split(r"[^A-Za-z0-9]+", value)[-1].lower()
        form, gazetteer = (1 if tld.isalpha() and 2 <= len(tld) <= 24 else -1), (1 if tld in TLDS else -1)
    elif name == "ip":
        form, gazetteer = (1 if all(p == "0" or not p.startswith("0") for p in value.split(".")) else -1), (-1 if digits.startswith("0") else 0)
    elif name == "card":
        form, gazetteer = (1 if len(digits) >= 15 else 0), (1 if digits.startswith(CARD_STARTS) else -1)
    elif name in ("phone", "local_phone"):
        form = 1 if 10 <= len(digits) <= 13 else 0
        gazetteer = (1 if any(digits[:k] in DIAL_CODES for k in (1, 2, 3)) else -1) if name == "phone" else (-1 if digits[0] in "01" else 1)
    elif name == "ssn":
        form, gazetteer = (-1 if value[:3] in ("000", "666") or value[0] == "9" or value[4:6] == "00" or value[7:] == "0000" else 1), 0
    elif name == "iban":
        length = IBAN_LENGTHS.get(value[:2])
        form, gazetteer = (1 if iban_valid(value) else -1), (-1 if length is None else 1 if length == len(value.replace(" ", "")) else -1)
    else:
        form, gazetteer = (1 if value.count(" ") >= 2 else 0), (1 if any(w.lower() in FIRST_NAMES for w in value.split()) else 0)
    before = words_before(text, start)
    context = 1 if any(CUE_PATTERNS[name].fullmatch(w) for w in before) else -1 if any(COUNTER_PATTERN.fullmatch(w) for w in before) else 0
    apart = (start == 0 or not text[start - 1].isalnum()) and (end == len(text) or not text[end].isalnum())
    return [form, gazetteer, context, 1 if apart else -1]


def shape(value: str) -> str:
    """The classes of a value's characters, runs in one."""
    return re.sub(r"(.)\1+", r"\1", re.sub(r"[^\W\d_]", "a", re.sub(r"\d", "0", value)))[:24]


def features(text: str, kind: int, start: int, end: int, votes: list[int]) -> list[int]:
    """Slots of what speaks of a span: votes, words and signs around it, shape, length. Each kind has its own."""
    import xxhash

    around = [f"before{k}:{w}" for k, w in enumerate(words_before(text, start)[:2])]
    after = WORDS.match(text[end : end + 2].lstrip() + text[end + 2 : end + 30].lower())
    found = ["bias", *around, f"after:{after[0].lower() if after else ''}", f"left:{shape(text[max(0, start - 1) : start])}", f"right:{shape(text[end : end + 1])}"]
    found += [f"shape:{shape(text[start:end])}", f"length:{min(9, (end - start) // 4)}", *(f"{n}:{v}" for n, v in zip(LABELERS, votes))]
    return [xxhash.xxh3_64_intdigest(f"{kind}|{f}".encode()) % SLOTS for f in found]


def apart_from(base: list[tuple[int, int]], more: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of more (kind, start, end), those that overlap no base span and none taken before: the leftmost first, then the longest."""
    base = sorted(base)
    starts, reach, far = [a for a, _ in base], [], 0
    for _, b in base:
        far = max(far, b)
        reach.append(far)
    out, last = [], 0
    for kind, a, b in sorted(more, key=lambda x: (x[1], -x[2], x[0])):
        k = bisect_right(starts, b - 1)  # base spans that start before this one ends
        if a >= last and (k == 0 or reach[k - 1] <= a):
            out.append((kind, a, b))
            last = b
    return out


def propose(text: str) -> list[tuple[int, int, int, int, list[int]]]:
    """(kind, start, end, votes in base 3, features) of all proposals; further kinds give way to base spans."""
    base = base_spans(text)
    full = []
    for kind, a, b in sorted(base + apart_from([(a, b) for _, a, b in base], more_spans(text))):
        votes, code = vote(text, kind, a, b), 0
        for v in votes:
            code = code * 3 + v + 1
        full.append((kind, a, b, code, features(text, kind, a, b, votes) if kind >= len(BASE) else []))
    return full


def vote_list(code: int) -> list[int]:
    out = []
    for _ in LABELERS:
        out.append(code % 3 - 1)
        code //= 3
    return out[::-1]


def reliabilities(patterns: list[tuple[int, int, int]], rounds: int = 50) -> dict[tuple[int, int], float]:
    """EM over (kind, votes, count): the probability that a span of this kind with these votes is personal.

    For each kind and labeler, P(vote | true) and P(vote | false), with a prior that leans to the vote.
    """
    out: dict[tuple[int, int], float] = {}
    for kind in {p[0] for p in patterns}:
        rows = [(v, n) for k, v, n in patterns if k == kind]
        votes = np.array([vote_list(v) for v, _ in rows]) + 1
        counts = np.array([n for _, n in rows], float)
        weight = min(50.0, counts.sum())
        lean = {True: np.array([0.15, 0.35, 0.5]), False: np.array([0.5, 0.35, 0.15])}
        prior, table = 0.5, {y: np.tile(lean[y], (len(LABELERS), 1)) for y in (True, False)}
        for _ in range(rounds):
            logs = {y: np.log(p) + sum(np.log(table[y][k][votes[:, k]]) for k in range(len(LABELERS))) for y, p in ((True, prior), (False, 1 - prior))}
            post = 1 / (1 + np.exp(np.clip(logs[False] - logs[True], -50, 50)))
            prior = (1 + (counts * post).sum()) / (2 + counts.sum())
            for y, share in ((True, post), (False, 1 - post)):
                for k in range(len(LABELERS)):
                    seen = np.array([(counts * share)[votes[:, k] == v].sum() for v in range(3)])
                    table[y][k] = (seen + weight * lean[y]) / (seen.sum() + weight)
        out |= {(kind, v): float(p) for (v, _), p in zip(rows, post)}
    return out


def train_classifier(spans: list[tuple[int, list[int], float]], steps: int = 300, rate: float = 2.0, decay: float = 2e-4) -> np.ndarray:
    """Logistic regression on (kind, feature slots, soft label): one weight per slot; each kind counts alike."""
    theta = np.zeros(SLOTS)
    if not spans:
        return theta
    kinds = np.array([k for k, _, _ in spans])
    width = max(len(f) for _, f, _ in spans)
    at = np.array([f + [SLOTS] * (width - len(f)) for _, f, _ in spans])  # the last slot stays zero
    soft = np.array([y for _, _, y in spans])
    _, inverse, counts = np.unique(kinds, return_inverse=True, return_counts=True)
    weight = 1.0 / counts[inverse]
    for _ in range(steps):
        miss = weight * (1 / (1 + np.exp(-np.append(theta, 0.0)[at].sum(axis=1))) - soft)
        theta -= rate * (np.bincount(at.ravel(), np.repeat(miss, width), SLOTS + 1)[:SLOTS] + decay * theta)
    return theta


def find_personal(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", accept: float = 0.5, train_spans: int = TRAIN_SPANS) -> DataFrame:
    """One row per row of docs: id, spans (array of kind name, start, end; by kind, then start)."""
    id_type = docs.schema[id_col].dataType.simpleString()
    fields = ("kind", "start", "end", "votes", "features")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("votes", pa.int32()), ("features", pa.list_(pa.int32()))]))
        for batch in batches:
            found = [[dict(zip(fields, s)) for s in propose(x.as_py() or "")] for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, kind)], names=["id", "spans"])

    proposed = stored(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(search, f"id {id_type}, spans array<struct<kind:int,start:bigint,end:bigint,votes:int,features:array<int>>>"), "proposals")
    more = proposed.select("id", F.explode(F.filter("spans", lambda s: s["kind"] >= len(BASE))).alias("s")).select("id", "s.*")
    counted = more.groupBy("kind", "votes").count().orderBy("kind", "votes").collect()
    soft = reliabilities([(r["kind"], r["votes"], r["count"]) for r in counted])
    turn = F.row_number().over(Window.partitionBy("kind").orderBy(F.xxhash64("id", "start", "end"), "id", "start", "end", "votes"))
    sample = more.withColumn("turn", turn).filter(F.col("turn") <= train_spans).orderBy("kind", "turn").select("kind", "votes", "features").collect()
    theta = train_classifier([(r["kind"], list(r["features"]), soft[r["kind"], r["votes"]]) for r in sample])
    weights = F.array(*[F.lit(float(w)) for w in theta]) if theta.any() else F.array_repeat(F.lit(0.0), SLOTS)
    score = lambda s: F.aggregate(s["features"], F.lit(0.0), lambda acc, k: acc + F.get(weights, k))
    edge = float(np.log(accept / (1 - accept)))
    names = F.array(*map(F.lit, KINDS))
    kept = F.filter("spans", lambda s: (s["kind"] < len(BASE)) | (score(s) >= edge))
    return proposed.select("id", F.transform(kept, lambda s: F.struct(F.get(names, s["kind"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("spans"))


def digest_of(spans: list[tuple[str, int, int]]) -> str:
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
