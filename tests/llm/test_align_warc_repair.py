"""Alignment, WARC archive and structure repair against plain versions."""

import gzip
import hashlib
import io
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.llm import align, repair, warc

BYTE_BPE, PIECES = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
SF = "/root/testdata/sf0.001"


# ---- alignment

@pytest.fixture(scope="module")
def pair():
    return align.TokenizerPair.read(BYTE_BPE, PIECES)


def plain_links(aligner, text):
    """(groups as text, Counter of id pairs) of a whole text, token by token."""
    if not text:
        return None
    raw = (" " + text).encode()
    a, b = aligner.a.encode(" " + text, add_special_tokens=False).ids, aligner.b.encode(text)
    ta, tb = [aligner.a_bytes[i] for i in a], [aligner.b_bytes[i] for i in b]
    if b"".join(ta) != raw or b"".join(tb) != raw:
        return None
    spans = []
    for ids, tokens in ((a, ta), (b, tb)):
        at, out = 0, []
        for i, t in zip(ids, tokens):
            out.append((at, at + len(t), i))
            at += len(t)
        spans.append(out)
    links, j = Counter(), 0
    for lo, hi, i in spans[0]:
        while spans[1][j][1] <= lo:
            j += 1
        k = j
        while k < len(spans[1]) and spans[1][k][0] < hi:
            links[i, spans[1][k][2]] += 1
            k += 1
    ends = sorted({s[1] for s in spans[0]} & {s[1] for s in spans[1]})
    groups = []
    for lo, hi in zip([0, *ends], ends):
        groups.append("|".join(",".join(str(i) for x, y, i in s if x >= lo and y <= hi) for s in spans))
    return len(a), len(b), groups, links


ODD = ["a", " ", "  ", " a  b ", "héllo wörld 日本 語 x", "▁a b", "a ▁b c", "a▁ b c", "<|endoftext|> </s> <0x41> [INST]", "\x00 a\x00b",
       "a b c", "it's we 're 's x", "𝒳𝒴 😀😀 é", "é ́x y", "a\tb \n c\r\nd", "1 2 33 $ % 'll", "x　y z", "\x1c \x1d a", "a ​b", "ﬁ x ﬀ", "", None,
       "日本語" * 50, "x" * 3000, "a b " * 700]


def test_alignment_equals_a_plain_version_whatever_the_parts(pair, monkeypatch, docs_rows):
    texts = ODD + [r.text for r in list(docs_rows.values())[:60]]
    whole = align.Aligner(pair)
    assert whole.cut
    want = [plain_links(whole, t) for t in texts]
    assert want[ODD.index("▁a b")] is None and want[0] is not None
    for part, kept in ((1 << 20, 400_000), (50, 5)):
        monkeypatch.setattr(align, "PART", part)
        monkeypatch.setattr(align, "KEPT", kept)
        for text, w, g in zip(texts, want, align.Aligner(pair).align(texts, detail=True)):
            assert (g is None) == (w is None), text
            if w is not None:
                assert g[0] == [w[0], w[1], len(w[2]), sum(w[3].values())] and g[4] == w[2]
                assert g[1] == hashlib.sha256(";".join(w[2]).encode()).hexdigest()
                assert dict(zip(g[2].tolist(), g[3].tolist())) == {a * whole.base + b: n for (a, b), n in w[3].items()}


def test_alignment_counts_over_documents(spark, pair):
    texts = ["a red fox", "a red fox", "red", None, "", "▁a", "a red héllo 日本", "fox fox fox"] + ["common text here"] * 40
    docs = spark.createDataFrame([(i if i else None, t, i, "n") for i, t in enumerate(texts)], "doc_id long, text string, key long, n_a string").repartition(3)
    aligner = align.Aligner(pair)
    found = {i: plain_links(aligner, t) for i, t in enumerate(texts)}
    counts = Counter(p for w in found.values() if w for p in w[3])
    best = {}
    for (a, _), n in counts.items():
        best[a] = max(best.get(a, 0), n)
    for heavy in (1 << 17, 20):  # all pairs by the broadcast, or most by the join
        got = {r.row.key: r for r in align.alignment_counts(docs, pair, heavy=heavy).collect()}
        assert set(got) == set(range(len(texts)))
        for i, w in found.items():
            r = got[i]
            if w is None:
                assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) == (0, 0, 0, 0, 0, 0, "")
            else:
                assert (r.n_a, r.n_b, r.n_groups) == (w[0], w[1], len(w[2])) and r.row.doc_id == (i or None) and r.row.n_a == "n"
                assert r.count_sum == sum(n * counts[p] for p, n in w[3].items())
                assert r.n_best == sum(n for p, n in w[3].items() if counts[p] == best[p[0]])
    assert align.alignment_counts(docs.where("false"), pair).count() == 0


# ---- WARC

def test_archive_of_pages_reads_back(spark):
    big, odd = "x" * 1500 + "\r\n\r\nWARC/1.1\r\n\r\né" + "y", "z" * 999
    rows = [(1, "http://a/", big), (2, "http://b/ c\r\nX: 1", big), (3, None, big), (4, "", odd), (5, "u", odd), (6, "u", None), (7, "u", ""),
            (8, "u", "é" * 500), (9, "u", "é" * 500), (9, "u", "é" * 500), (None, "n", big), (10, "u", "\x00" + big), (11, "u", "w" * 300_000)]
    pages = spark.createDataFrame([(*r, 1, "s") for r in rows], "page_id long, url string, html string, key long, sha256 string").repartition(4)
    archive = warc.archive_pages(pages)
    assert archive.payloads.count() == len({r[2] for r in rows if r[2] and len(r[2].encode()) >= 1000})
    files = warc.export_warc(archive)
    read = warc.read_warc(spark, files)
    got = warc.page_report(read).collect()
    top = {}
    for i, _, h in rows:
        top[h] = max(top.get(h, -1), -1 if i is None else i)
    want = []
    seen = set()
    for i, _, h in rows:
        raw = (h or "").encode()
        again = len(raw) >= 1000 and (i != top[h] or (i, h) in seen)
        seen.add((i, h))
        want.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", top[h] if again else None))
    order = lambda x: tuple((v is not None, v) for v in x)
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)
    assert {r.url for r in read.select("url").collect()} == {r[1] for r in rows}
    # exact bytes: what comes out of the files is what went in, record by record, through an archive again
    again = warc.archive_records(read)
    first = Counter(bytes(r.record) for r in warc.reconstruct(archive).collect())
    assert first == Counter(bytes(r.record) for r in warc.reconstruct(again).collect()) and sum(first.values()) == len(rows)
    archive.close()
    again.close()


def test_archive_of_no_pages(spark):
    archive = warc.archive_pages(spark.createDataFrame([], "page_id long, url string, html string"))
    assert warc.reconstruct(archive).count() == 0
    assert warc.page_report(warc.read_warc(spark, warc.export_warc(archive))).count() == 0


def test_foreign_records_keep_their_bytes_and_broken_ones_are_errors():
    records = [b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 5\r\nX-Folded: a\r\n b\r\n\r\nab\r\nc",
               b"WARC/1.1\r\nwarc-type:response\r\nContent-Type: application/http; msgtype=response\r\nCONTENT-LENGTH:  23\r\n\r\nHTTP/1.1 200 OK\r\n\r\n\x00\xff\r\n",
               b"WARC/1.1\r\nWARC-Type: metadata\r\nContent-Length: 0\r\n\r\n"]
    records[1] = records[1].replace(b"  23", b"  %d" % len(b"HTTP/1.1 200 OK\r\n\r\n\x00\xff\r\n"))
    data = b"\r\n\r\n".join(records) + b"\r\n\r\n"
    members = b"".join(gzip.compress(r + b"\r\n\r\n") for r in records)
    for stream in (io.BytesIO(data), gzip.GzipFile(fileobj=io.BytesIO(members))):
        got = list(warc.records_of(stream))
        assert [h + p for _, h, p in got] == records and got[1][2] == b"\x00\xff\r\n" and got[0][0]["x-folded"] == "a b"
    for broken in (data[:-8], b"HTTP/1.1 200\r\n\r\n", b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc", b"WARC/1.1\r\nA: b"):
        with pytest.raises((ValueError, KeyError)):
            assert len(list(warc.records_of(io.BytesIO(broken)))) > 9


# ---- structure repair

WHITE = " \t\n\x0b\x0c\r"
STEPS = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
ROLES = {"u": "user", "a": "assistant"}


def plain_repair(rows):
    """The report of one conversation's sorted rows (turn, role, text): least
    (cost, audit) over all repairs, audits compared as whole strings."""
    seen, fault = set(), []
    for _, role, text in rows:
        body = text.rstrip(WHITE)
        fault.append("b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    initial = [role[:1] for _, role, _ in rows]
    never = (10**9, "", ())

    def inserts(best):
        for _ in range(4):
            for s, steps in STEPS.items():
                for c in set(steps) & set(ROLES):
                    cost, audit, out = best[steps[c]]
                    best[s] = min(best[s], (cost + 3, "I" + audit, ((ROLES[c], ""), *out)))
        return best

    best = inserts({"": (0, "", ()), "a": (0, "", ()), "s": never, "u": never})
    for i in reversed(range(len(rows))):
        now = {}
        for s, steps in STEPS.items():
            options = [(best[s][0] + 4, "D" + best[s][1], best[s][2])]
            if fault[i] not in ("b", "d"):
                more = 3 * (fault[i] == "t")
                for c, to in steps.items():
                    cost, audit, out = best[to]
                    if initial[i] == c:
                        options.append((cost + more, "K" + audit, (rows[i][1:], *out)))
                    if c in ROLES:
                        options.append((cost + more + 3, "R" + audit, ((ROLES[c], rows[i][2]), *out)))
            now[s] = min(options)
        best = inserts(now)
    cost, audit, out = best[""]
    turns = [t for t, _, _ in rows if t is not None]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, fault.count("b"), fault.count("d"), fault.count("t"),
            sum(x + y not in ("su", "ua", "au") for x, y in zip(initial, initial[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest())


def plain_report(rows):
    convs = {r[0]: [] for r in rows}
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        convs[c] += [(t, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    place = lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest())
    return {c: plain_repair(sorted(v, key=place)) for c, v in convs.items()}


def made_up(n, seed=5):
    rng, rows = random.Random(seed), []
    for c in range(n):
        for t in range(rng.randint(0, 12)):
            rows.append((None if c % 50 == 0 and rng.random() < 0.3 else c, rng.choice([t, t, t, None, t + 1]),
                         rng.choice(["user", "assistant", "system", "user", "assistant", "tool", None, "", "ubuntu"]),
                         rng.choice(["hi.", "ok", "", " ", None, "x\ny?", "é!", "done.  \n", "a  "])))
    return rows


@pytest.mark.parametrize("block", [1, 3, repair.BLOCK])
def test_repair_equals_the_best_of_all_repairs(spark, block):
    rows = made_up(150) + [(900, 0, "user", "same.")] * 40 + [(901, t, "user", "same.") for t in range(300)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, cost long, audit string")
    got = {r[0]: tuple(r)[1:] for r in repair.report(repair.damaged(df), df, block).collect()}
    want = plain_report(rows)
    assert got == want


def test_repair_of_the_table_and_of_nothing(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    got = {r[0]: tuple(r)[1:] for r in repair.report(repair.damaged(df), df).collect()}
    assert got == plain_report([(r.conv_id, r.turn, r.role, r.text) for r in df.collect()])
    none = df.where("false")
    assert repair.report(repair.damaged(none), none).count() == 0
    gone = df.select(F.lit(1).cast("long").alias("conv_id"), "turn", "role", "text").limit(3)
    row = repair.report(repair.damaged(gone).where("false"), gone).collect()
    assert [tuple(r) for r in row] == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_repaired_rows_are_well_formed(spark):
    df = spark.createDataFrame(made_up(60, seed=8), "conv_id long, turn long, role string, text string")
    _, pieces = repair.plan(df, 2)
    by = {}
    for r in repair.repaired(df, pieces).collect():
        by.setdefault((r.has_conv, r.conv), []).append(r)
    assert by and all(re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in v)) and [r.position for r in v] == list(range(len(v))) for v in by.values())
