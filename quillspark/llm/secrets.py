"""Secret scans: candidate strings by pattern, false positives removed by a random forest.

Candidates are values of a name that speaks of a secret (in quotes to the closing one, of any length), passwords in addresses
and options, blocks of private keys, and long runs of key characters; they are found in time linear in the text. The forest (MLlib's,
fitted to labelled findings that are drawn from rules with a fixed seed, then broadcast) judges each by its length,
character transitions, dictionary coverage, likeness to a path, and the words beside it. One pass without a shuffle finds,
scores and masks the secrets of each whole text.
"""

from __future__ import annotations

import base64
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.llm.common import fresh, mapped
from quillspark.llm.trees import exported, forest_score

MASK = "[SECRET]"
_KEY = r"token|secret|passwd|password|passphrase|pwd|api[_-]?key|apikey|access[_-]?key|private[_-]?key|auth|bearer|credential|signature|key"
#: A name, and what stands between it and its value; possessive, so that blanks are read once.
_NAME = re.compile(rf"(?i:{_KEY})[\w-]{{0,30}}+[\"']?([^\S\n]*+)(:=|=>|==?|:)?+[^\S\n]*+")
_BARE = re.compile(r"[^\s\"'<>,;()]*+")
_QUOTED = {q: re.compile(rf"((?:[^\n\\{q}]++|\\.)*+){q}") for q in "\"'"}
#: User and password before a host, and as an option of a command.
_USERS = re.compile(r"://[^\s/:@\"'<>]*+:([^\s/@\"'<>]++)@|(?<!\S)(?:-u|--user)[=\s][^\S\n]*+[\"']?[^\s:\"']++:([^\s\"']++)")
_WORD = re.compile(rf"(?i:{_KEY})")
_LONG = re.compile(r"[A-Za-z0-9+/_=.\-]{20,}")
# To the END line, or without one before the next BEGIN, headers and what follows them up to a hyphen.
_PEM = re.compile(
    r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY(?: BLOCK)?-----"
    r"(?:(?:[^-]++|-(?!----(?:BEGIN|END) ))*+-----END [A-Z ]{0,40}PRIVATE KEY(?: BLOCK)?-----|(?:\s*+(?:Proc-Type|DEK-Info)[^\S\n]*+:[^\n]*+)*+[^-]*+)"
)
#: Prefixes by which public services mark their keys.
_MARKED = re.compile(r"(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_\w{20,}|xox[abprs]-|sk[-_](?:live|test|proj)?|AIza|eyJ[\w-]+\.|glpat-|npm_|pypi-|SG\.")
_SECRET_WORDS = re.compile(rf"(?i)(?:{_KEY})[\w-]*[\"']?\s*(?::=|=>|=|:)?\s*[\"']?$")
_PASSWORD_WORDS = re.compile(r"(?i)(?:pass(?:wd|word|phrase)?|pwd|secret|://[^\s/:@]*|-u\s+\S+|--user[=\s]+\S+)[\w-]*[\"']?\s*(?::=|=>|=|:)?\s*[\"']?$")
_BENIGN = r"sha-?\d*|md5|checksum|digest|hash|commit|revision|rev|uuid|guid|etag|build|version|path|file|dir|url|href|src|id|isbn|doi|license"
_BENIGN_WORDS = re.compile(rf"(?i)(?:{_BENIGN})[\w-]*[\"']?\s*(?::=|=>|=|:)?\s*[\"']?$")
#: Up to such a word, what follows a value: a closing quote, a bracket or comment sign, "is the".
_LEAD = r"(?i)[\"'\])}]*[\s,;:#(\[/<-]*(?:(?:is|as|was|are|for)\s+)?(?:(?:the|a|an|its|our|my|your)\s+)?"
_SECRET_AFTER, _BENIGN_AFTER = re.compile(rf"{_LEAD}(?:{_KEY})\b"), re.compile(rf"{_LEAD}(?:{_BENIGN})\b")
_HOLDER = re.compile(r"(?i)x{4,}|\*{3,}|your|example|changeme|placeholder|dummy|sample|redacted|<|\$\{|\.\.\.|todo|none$|null$|true$|false$|1234567")
#: A dictionary of words that paths and identifiers are made of.
DICTIONARY = frozenset("about access account action admin after api app application archive article assets auth author back base before begin between book bucket build cache call change check class client cloud code color column common company config connect console contact content context control copy core count create current data date default delete demo description design detail dev directory display doc docs document domain down download edit element email enable end engine entry error event example export file final first folder font form format function game general get global group handler header help history home host html http image images import index info input install item java json key language last layout level library license link list local location login main manager master media member menu message method model module month more name network news node number object open option order output package page param parent part password path people photo place player plugin policy post print private process product profile project public query question read record reference release report request resource response result return root sample save script search secret section security select server service session set setting share site size source start state static status storage string style support system table target team template test text theme time title token tool topic type update upload url user util value version video view web week window with word work world write year".split())
_PIECES = re.compile(r"[A-Z]?[a-z]{3,}|[A-Z]{3,}")
FEATURES = ("length", "transitions", "entropy", "digits", "upper", "vowels", "dictionary", "slashes", "dots", "separators", "hex", "marked", "secret_word", "benign_word", "secret_after", "benign_after", "placeholder", "uuid", "repeats", "blanks", "password_word")


def candidates(text: str) -> list[tuple[int, int]]:
    """Start and end of each candidate in a text, disjoint and in order; where two overlap the one that starts first, then the longer."""
    spans = [m.span() for m in _PEM.finditer(text)]
    spans += [m.span(m.lastindex) for m in _USERS.finditer(text)]
    at = 0
    while m := _NAME.search(text, at):
        at = a = m.end()
        if not (m[1] or m[2]) or a == len(text):
            continue
        quoted = _QUOTED[text[a]].match(text, a + 1) if text[a] in _QUOTED else None
        if quoted:
            a, b = quoted.span(1)
        else:
            a += text[a] in _QUOTED
            b = _BARE.match(text, a).end()
        value = text[a:b] if quoted else text[a:b].rstrip(".!?#$%&*|")
        # After a mere blank, a value without a digit is the next word of a sentence.
        if m[2] or any(c.isdigit() for c in value):
            # "authorization: bearer x": the value is a name itself.
            at = a if _WORD.fullmatch(value) else b
            if value.strip() and at == b:
                spans.append((a, a + len(value)))
    for m in _LONG.finditer(text):
        value = m[0].strip(".-=/")
        digits, letters = any(c.isdigit() for c in value), any(c.isalpha() for c in value)
        mixed = len(value) >= 32 and not value.islower() and not value.isupper() or len(value) >= 40 and value.isalpha()
        if len(value) >= 20 and letters and (digits or mixed):
            a = text.index(value, m.start())
            # An assignment without blanks is a name, a sign and a value.
            name, sign, rest = value.partition("=")
            if sign and len(rest.strip("=")) >= 16:
                a, value = a + len(name) + 1, rest
            spans.append((a, a + len(value)))
    out: list[tuple[int, int]] = []
    for a, b in sorted(set(spans), key=lambda s: (s[0], -s[1])):
        if not out or a >= out[-1][1]:
            out.append((a, b))
    return out


def features(text: str, a: int, b: int) -> list[float]:
    value, before, after = text[a:b], text[max(0, a - 48) : a], text[b : b + 48]
    n = len(value)
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.isalpha() else "o" for c in value]
    counts = Counter(value)
    letters = sum(k in "ul" for k in kinds)
    covered = sum(len(w) for w in _PIECES.findall(value) if w.lower() in DICTIONARY or w.lower().rstrip("s") in DICTIONARY)
    return [
        float(min(n, 200)), sum(x != y for x, y in zip(kinds, kinds[1:])) / max(1, n - 1), -sum(k / n * math.log2(k / n) for k in counts.values()),
        kinds.count("d") / n, kinds.count("u") / n, sum(c in "aeiouAEIOU" for c in value) / max(1, letters), covered / n,
        value.count("/") / n, value.count(".") / n, sum(value.count(c) for c in "-_") / n, float(all(c in "0123456789abcdefABCDEF" for c in value)),
        float(bool(_MARKED.match(value) or value.startswith("-----BEGIN"))), float(bool(_SECRET_WORDS.search(before))), float(bool(_BENIGN_WORDS.search(before))), float(bool(_SECRET_AFTER.match(after))), float(bool(_BENIGN_AFTER.match(after))), float(bool(_HOLDER.search(value))),
        float(bool(re.fullmatch(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", value))), max(counts.values()) / n,
        value.count(" ") / n, float(bool(_PASSWORD_WORDS.search(before))),
    ]


def labelled_findings(rows: int = 1500, seed: int = 7) -> list[tuple[str, str, int]]:
    """Text before, value, 1 for a secret: labelled findings drawn from rules, half of them false positives."""
    r = random.Random(seed)
    words = sorted(DICTIONARY)
    pick = lambda chars, n: "".join(r.choice(chars) for _ in range(n))
    low, up, dig = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    names = ["token", "api_key", "secret", "password", "auth_token", "client_secret", "access_key", "Token", "API_KEY", "SECRET", "PASSWORD", "TOKEN"]
    signs = [' = "', "=", ": ", ": '", ' := "', "='"]
    secret = [
        lambda: pick("0123456789abcdef", r.choice([32, 40, 40, 40, 64])), lambda: pick("0123456789ABCDEF", r.choice([32, 40, 40, 64])),
        lambda: base64.b64encode(bytes(r.randrange(256) for _ in range(r.choice([20, 24, 30, 32])))).decode().rstrip("="), lambda: pick(low + up + dig, r.randrange(20, 48)),
        lambda: pick(low + up + dig + "!@#%^&*_-", r.randrange(10, 20)),
    ]
    pem = lambda kind, head: f"-----BEGIN {kind}PRIVATE KEY-----\n{head}" + "\n".join(pick(low + up + dig + "+/", 64) for _ in range(r.randrange(3, 20))) + f"\n-----END {kind}PRIVATE KEY-----"
    # Words that no dictionary has.
    coined = lambda: "".join(r.choice("bcdfghklmnprstvw") + r.choice("aeiou") + r.choice(["", "r", "n", "st"]) for _ in range(r.randrange(2, 4)))
    digitless = [
        lambda: pick(low + up, r.randrange(12, 48)), lambda: pick(low, r.randrange(20, 48)), lambda: pick(up, r.randrange(20, 48)), lambda: pick(low + up + "!@#%^&*_-", r.randrange(10, 24)),
        *[lambda: "".join(coined().title() for _ in range(r.randrange(3, 5)))] * 2, lambda: pem(r.choice(["", "RSA ", "EC "]), ""),
        lambda: pem("RSA ", f"Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,{pick(dig + 'ABCDEF', 32)}\n\n"),
    ]
    plain = [
        *[lambda: "".join(coined() for _ in range(2))] * 3, lambda: r.choice(words) + r.choice(["ing", "ment", "ation", "ized", ""]) + r.choice(words), lambda: coined().title() + coined(),
        lambda: r.choice("._-/").join(r.choice(words) for _ in range(r.randrange(2, 5))), lambda: r.choice(words) + "".join(r.choice(words).title() for _ in range(r.randrange(1, 4))),
        lambda: "_".join(coined() for _ in range(2)), lambda: r.choice(["your_token_here", "changeme", "placeholder", "xxxxxxxxxxxx", "********", "<insert-key>", "${TOKEN}", "EXAMPLE_TOKEN"]),
    ]
    marked = [
        lambda: "AKIA" + pick(up + dig, 16), lambda: "ghp_" + pick(low + up + dig, 36), lambda: "sk-" + pick(low + up + dig, 40), lambda: "AIza" + pick(low + up + dig + "-_", 35),
        lambda: "xoxb-" + pick(dig, 12) + "-" + pick(low + up + dig, 24), lambda: "eyJ" + pick(low + up + dig, 20) + "." + pick(low + up + dig, 40) + "." + pick(low + up + dig + "-_", 43),
    ]
    harmless = [
        lambda: (r.choice(["sha256:", "commit ", "md5=", "checksum: ", "digest ", "revision ", "etag: "]), pick("0123456789abcdef", r.choice([32, 40, 64]))),
        lambda: (r.choice(["id: ", "uuid=", "", "token: "]), "-".join(pick("0123456789abcdef", n) for n in (8, 4, 4, 4, 12))),
        lambda: (r.choice(["path=", "file ", "src: ", ""]), "/".join(r.choice(words) for _ in range(r.randrange(3, 6))) + f"{r.randrange(100)}.txt"),
        lambda: (r.choice(["", "version ", "key: "]), r.choice("_-").join(r.choice(words) for _ in range(r.randrange(3, 6))) + str(r.randrange(1000))),
        lambda: (r.choice(names) + r.choice(signs), r.choice(["your_token_here1", "xxxxxxxxxxxxxxxx1", "changeme1234567", "EXAMPLE_TOKEN_1", "<insert-key-1>", "1234567890123456", "password1234567", "${TOKEN_2}"])),
        lambda: (r.choice(names) + r.choice(signs), r.choice(words) + r.choice(words).title() + "(" + r.choice(words) + str(r.randrange(10))),
        lambda: ("", "".join(r.choice(words).title() for _ in range(4)) + str(r.randrange(100))), lambda: (r.choice(["key ", "token ", ""]), pick(dig, r.randrange(8, 17))),
        lambda: (r.choice(["", "url: "]), r.choice(words) + ".example.com/" + r.choice(words) + "/" + str(r.randrange(10**6)) + "-" + r.choice(words)),
        lambda: (r.choice(["", "key "]), r.choice(words) + "." + r.choice(words) + "@" + r.choice(words) + str(r.randrange(99)) + ".example.com"),
    ]
    out = []
    for k in range(rows):
        if k % 2:
            before, value = r.choice(harmless)()
            out.append((before, value, 0))
        elif k % 6 == 0:
            out.append((r.choice(["", "use ", *(n + s for n in names[:4] for s in signs[:2])]), r.choice(marked)(), 1))
        else:
            out.append((r.choice(names) + r.choice(signs), r.choice(secret)(), 1))
    # Half of these have digits, so that those keep their weight.
    for k in range(rows):
        if k % 4 == 3:
            out.append((*r.choice(harmless)(), 0))
        else:
            value = r.choice((digitless, plain, secret)[k % 4])()
            out.append(("" if value.startswith("-----") else r.choice(names) + r.choice(signs), value, int(k % 4 != 1)))
    # What is short, quoted, in an address or in a run of letters; half of it harmless.
    quote, private = [' = "', '="', ": '", "='"], ["password", "passwd", "PASSWORD", "db_password", "passphrase", "pwd", "secret"]
    said = lambda n: " ".join(r.choice((coined(), r.choice(words))) for _ in range(n))
    short = [
        lambda: (r.choice(private) + r.choice(signs), r.choice((coined(), r.choice(words))) + pick(dig, r.randrange(1, 4))), lambda: (r.choice(private) + r.choice(signs), pick(low + up + dig, r.randrange(5, 9))),
        lambda: (r.choice(private) + r.choice(quote), said(r.randrange(1, 4)) + " " + pick(low + dig, r.randrange(1, 4)) + " " + said(r.randrange(1, 4))), lambda: (r.choice(private) + r.choice(quote), pick(low + up + dig + "<>,;()!", r.randrange(10, 24))),
        lambda: (r.choice(["postgres", "https", "mysql", "redis"]) + "://" + coined() + ":", pick(low + up + dig, r.randrange(8, 20))), lambda: (r.choice(["curl -u ", "--user ", "--user="]) + coined() + ":", pick(low + up + dig, r.randrange(8, 20))),
        lambda: (r.choice(private) + r.choice(signs), "".join(r.choice((coined(), r.choice(words))).title() for _ in range(3))), lambda: (r.choice(["", "use ", said(2) + " "]), pick(low + up, r.randrange(32, 64))),
        lambda: ("", f"-----BEGIN PGP PRIVATE KEY BLOCK-----\nVersion: x\n\n{pick(low + up + dig, 64)}\n=ab1Z\n-----END PGP PRIVATE KEY BLOCK-----"),
    ]
    idle = [
        lambda: (r.choice(names) + r.choice([": ", "=", " ", " = "]), pick(dig, r.randrange(1, 6))), lambda: (r.choice(names) + r.choice(signs), r.choice(words)), lambda: (r.choice(names) + r.choice([": ", "="]), coined()),
        lambda: (r.choice(["key", "token", "signature", "auth", "key_name"]) + r.choice(quote), said(r.randrange(2, 6))), lambda: (r.choice(["key", "token", "signature", "credential"]) + r.choice(quote), said(2) + " " + pick(dig, r.randrange(1, 4)) + " " + said(2)),
        lambda: (r.choice(private) + r.choice([": ", ' = "']), said(r.randrange(1, 5))), lambda: (r.choice(["", "see ", said(2) + " "]), r.choice(["", "com", "org"]) + "".join(r.choice(words).title() for _ in range(r.randrange(5, 9)))),
        lambda: (r.choice(["", "see "]), r.choice("._-/").join(r.choice(words) for _ in range(r.randrange(6, 10)))), lambda: (r.choice(["", said(2) + " "]), r.choice((pick("ab", 1), r.choice("xz-="))) * r.randrange(40, 60)),
        lambda: (r.choice(["key ", "token ", "the key "]), r.choice(words) + pick(dig, r.randrange(1, 3))),
    ]
    for k in range(rows):
        out.append((*r.choice((short, idle)[k % 2])(), 1 - k % 2))
    return out


def with_words_after(findings: list[tuple[str, str, int]], seed: int = 8) -> list[tuple[str, str, str, int]]:
    """Text before, value, text after, label: each finding with words after it that tell nothing, and for every third a second one
    whose telling words come after the value: those of its kind, none before it."""
    r = random.Random(seed)
    words = sorted(DICTIONARY - {"file", "hash", "id", "key", "path", "version", "build", "url", "license", "token", "secret", "password"})
    plain = lambda: r.choice(["", "", "\n", ".", f" {r.choice(words)}", f", {r.choice(words)} {r.choice(words)}", f"\n{r.choice(words)}"])
    lead = lambda: r.choice([" (", " # ", " is the ", " is our ", ", the ", " as "])
    secret, benign = ["token", "api key", "password", "secret", "access key"], ["sha256", "md5", "checksum", "commit", "digest", "revision", "uuid", "hash"]
    out = []
    for k, (before, value, y) in enumerate(findings):
        quote = before[-1:] if before[-1:] in ("'", '"') else ""
        out.append((before, value, quote + plain(), y))
        if k % 3 == 0 and y:
            out.append(("", value, lead() + r.choice(secret), 1))
        if k % 3 == 0 and (not y or re.fullmatch("[0-9a-f]{32,64}", value)):
            out.append(("", value, lead() + r.choice(benign), 0))
    return out


def forest(spark: SparkSession, trees: int = 20, depth: int = 8) -> RandomForestClassificationModel:
    """MLlib's forest over the labelled findings, in their text."""
    rows = [(float(y), features(before + value + after, len(before), len(before) + len(value))) for before, value, after, y in with_words_after(labelled_findings())]
    table = spark.createDataFrame(rows, "label double, x array<double>").select("label", array_to_vector("x").alias("features"))
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=7).fit(table.coalesce(1))


def fit(spark: SparkSession, **parameters) -> list[tuple[np.ndarray, ...]]:
    return [exported(t) for t in forest(spark, **parameters).trees]


_FINDING = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("length", T.IntegerType()), T.StructField("score", T.DoubleType())]))


def scan(documents: DataFrame, threshold: float = 0.5, mask: str = MASK) -> DataFrame:
    """``documents`` with n_candidates, findings and redacted: what the forest takes for secrets, and the text with those masked.

    ``findings`` are in the order of the text, with start and length in characters. A null text stays null, without
    candidates; repeated rows are returned as often as they occur; columns of those three names are replaced.
    """
    sent = documents.sparkSession.sparkContext.broadcast(fit(documents.sparkSession))
    kept = documents.drop("n_candidates", "findings", "redacted")
    where = kept.columns.index("text")

    def of(batches):
        for batch in batches:
            texts = batch.column(where).to_pylist()
            spans = [candidates(t) if t else [] for t in texts]
            x = [features(t, a, b) for t, found in zip(texts, spans, strict=True) for a, b in found]
            scores = forest_score(sent.value, np.array(x).reshape(-1, len(FEATURES))).tolist()
            counts, findings, masked, at = [], [], [], 0
            for t, found in zip(texts, spans, strict=True):
                own = [(a, b, s) for (a, b), s in zip(found, scores[at : at + len(found)], strict=True) if s >= threshold]
                at += len(found)
                counts.append(len(found))
                findings.append([{"start": a, "length": b - a, "score": s} for a, b, s in own])
                pieces, last = [], 0
                for a, b, _ in own:
                    pieces += [t[last:a], mask]
                    last = b
                masked.append(None if t is None else "".join([*pieces, t[last:]]))
            kind = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(counts, pa.int64()), pa.array(findings, kind), pa.array(masked, pa.string())], names=[*batch.schema.names, "n_candidates", "findings", "redacted"])

    schema = T.StructType([*kept.schema.fields, T.StructField("n_candidates", T.LongType()), T.StructField("findings", _FINDING), T.StructField("redacted", T.StringType())])
    return mapped(kept, of, schema)


def redact(documents: DataFrame, **parameters) -> DataFrame:
    """``documents`` with their secrets masked; n_chars, where there is one, follows the text. All rows and columns stay."""
    # Columns of the input that are called like scan's results stay.
    results = ("n_candidates", "findings", "redacted")
    own = [c for c in documents.columns if c.lower() in results]
    aside = fresh(documents, *[f"_{c}" for c in own])
    found = scan(documents.withColumnsRenamed(dict(zip(own, aside, strict=True))), **parameters).withColumn("text", F.col("redacted"))
    if "n_chars" in documents.columns:
        length = F.char_length("text").cast(documents.schema["n_chars"].dataType)
        found = found.withColumn("n_chars", F.when(F.size("findings") > 0, length).otherwise(F.col("n_chars")))
    names = dict(zip(own, aside, strict=True))
    return found.select(*[F.col(f"`{names.get(c, c)}`").alias(c) for c in documents.columns])
