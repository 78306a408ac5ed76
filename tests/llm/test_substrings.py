import re

import pandas as pd
import pytest

from netbaseline.llm import substring_dedup as S

PASSAGE = "One passage goes on for a while. " + " ".join(f"word{k}" for k in range(60)) + ". It ends here at last."
JAPANESE = "".join(chr(0x3042 + (k * k) % 80) for k in range(270))


def pieces(text):
    """Lines with their sentences, as text: ``[[(from, to), ...], ...]``."""
    lines, at = [], 0
    for line in re.findall(r"[^\n]*\n+|[^\n]+$", text):
        cuts, last = [], 0
        for m in re.finditer(r"[.!?]+[ \t\r]+|[。！？｡]+|\n+$", line):
            cuts.append((at + last, at + m.end()))
            last = m.end()
        if last < len(line):
            cuts.append((at + last, at + len(line)))
        lines.append(cuts)
        at += len(line)
    return lines


def brute(rows, min_words=25, min_chars=200):
    """A scan in the order of ids with a set of the norms seen; the rows' ids differ."""
    plain = lambda x: " ".join(x.lower().split())
    norm = lambda x: re.sub("[.!?。！？｡]+$", "", plain(x)) or plain(x)
    seen, out = set(), []
    for d, t in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        if t is None:
            out.append((d, None))
            continue
        new, flags = set(), []
        for cuts in pieces(t):
            whole = norm(t[cuts[0][0]:cuts[-1][1]])
            line_again = bool(whole) and whole in seen | new
            own = {whole} if whole else set()
            marks = []
            for a, b in cuts:
                x = norm(t[a:b])
                again = bool(x) and (line_again if x == whole else x in seen | new | (own - {whole}))
                own |= {x} if x else set()
                marks.append([a, b, x, again or line_again, line_again])
            new |= own
            flags += marks
        seen |= new
        keep, k = [True] * len(flags), 0
        while k < len(flags):
            if not flags[k][3]:
                k += 1
                continue
            e = k
            while e < len(flags) and (flags[e][3] or not flags[e][2]):
                e += 1
            run = flags[k:e]
            long = (sum(len(t[f[0]:f[1]].split()) for f in run) >= min_words
                    or sum(len("".join(t[f[0]:f[1]].lower().split())) for f in run) >= min_chars)
            for j in range(k, e):
                keep[j] = not (long or flags[j][4])
            k = e
        out.append((d, "".join(t[f[0]:f[1]] for f, s in zip(flags, keep) if s)))
    return sorted(out, key=repr)


ROWS = [(1, "A clean start. " + PASSAGE + "\nIts own end."), (2, "Of its own.\n" + PASSAGE.upper() + " Tail here."),
        (3, PASSAGE.replace(" ", "  ")), (4, "Nothing shared. It ends here at last."), (5, None), (6, ""),
        (7, "\n\n . ! \n"), (8, PASSAGE + "\n" + PASSAGE), (None, "No id. " + PASSAGE), (9, "x" * 50_000),
        (10, "Read more\nown line 10\nread  MORE\n" + JAPANESE), (11, "Read more\nown line 11\n\n" + JAPANESE + "。 終わり。新しい"),
        (12, "前。" + JAPANESE + "。後"), (13, "Two parts. Of a line.\nx"), (14, "y\ntwo parts. of a line."), (15, "Two parts. But new.")]


def test_passages_lines_and_unspaced_text(spark):
    df = spark.createDataFrame([(*r, "z") for r in ROWS], "doc_id long, text string, removed string").repartition(3)
    out = S.dedup_substrings(df).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in out), key=repr) == brute(ROWS)
    by = {r["doc_id"]: r for r in out}
    assert by[1]["text"] == ROWS[0][1] and by[1]["n_removed"] == 0
    assert by[2]["text"] == "Of its own.\nTail here." and ROWS[1][1][by[2]["removed"][0]["lo"]:by[2]["removed"][0]["hi"]].startswith("ONE PASS")
    assert by[3]["text"] == "" and by[8]["n_removed"] == 6 and by[None]["text"] == "No id. "
    assert by[11]["text"] == "own line 11\n\n 終わり。新しい" and by[12]["text"] == "前。後"
    assert by[14]["text"] == "y\n" and by[15]["text"] == ROWS[15][1]
    assert S.dedup_substrings(df.where("false")).collect() == []


def test_rows_of_one_id_and_without_id(spark):
    """Different texts of one id, or without one, are documents of their own; equal rows are copies of one."""
    line = "The same first line of them all"
    rows = [(2, line + "\na"), (2, line + "\nb"), (2, line + "\nb"), (None, line + "\nc"), (None, line + "\nd"), (1, "else")]
    got = [r["text"] for r in S.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    cut = sorted(x for x in got if line not in x and x != "else")
    assert cut in (["b", "b", "c", "d"], ["a", "c", "d"]) and len(got) == 6
    none = [(None, f"{line}\n{k}") for k in range(3)]
    got = [r["text"] for r in S.dedup_substrings(spark.createDataFrame(none, "doc_id long, text string")).collect()]
    assert sum(line in x for x in got) == 1


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_whole_table(spark, folder):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    out = S.dedup_substrings(spark.read.parquet(f"{folder}/documents.parquet")).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in out), key=repr) == brute(rows)


def test_digests_leave_a_task_together():
    """One frame for many short documents: a frame a document costs more than its digests."""
    batch = pd.DataFrame({"u_doc": range(500), "u_sub": 3, "u_text": [f"Line {k}.\nCommon line" for k in range(500)]})
    frames = list(S._digest_rows(iter([batch, batch.assign(u_doc=batch["u_doc"] + 500)])))
    assert len(frames) == 1
    assert frames[0].groupby("u_doc").size().tolist() == [2] * 1000 and set(frames[0]["u_sub"]) == {3}
    assert frames[0].groupby(["u_hi", "u_lo"])["u_doc"].nunique().max() == 1000
