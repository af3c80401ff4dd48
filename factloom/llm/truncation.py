"""Texts that were cut before their end.

Method: self-joins by prefix over the ends of texts. The last lines of texts are sorted together with all lines of the corpus: one
that is a strict prefix of a longer line and no line itself goes on elsewhere. Last tokens are joined with all tokens by
a hashed prefix. Whether the form of a text allows it to end there is checked after, and decides alone where the corpus
holds no longer copy. Whole texts are not joined: see README.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.runtime import staged

#: Marks of the layouts of commit texts (fixed values).
HUNK = re.compile(r"@@ -\d+(?:,(\d+))? \+\d+(?:,(\d+))? @@(?: .*)?$")
GIT_FILE = re.compile(r"diff --git a/(\S+) b/(\S+)$")
GIT_INDEX = re.compile(r"index [0-9a-f]{7,40}\.\.[0-9a-f]{7,40}(?: \d{6})?$")
GIT_MODE = re.compile(r"(?:new file mode|deleted file mode|old mode|new mode) \d{6}$")
BINARY = re.compile(r"Binary files \S+ and \S+ differ$")
SVN_FILE = re.compile(r"Index: \S+$")
MAIL_END = re.compile(r"(?:^|\n)-- ?\n\d+\.\d+\.\d+\n?$")
PERSON = re.compile(r"[^<>]*<[^<>@\s]+@[^<>\s]+>$")
TRAILER = re.compile(r"[A-Z][A-Za-z]+(?:-[A-Za-z]+)*: \S")
CHANGE = re.compile(r"Change-Id: I[0-9a-f]{40}$")
STAMP = r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d"
#: What ends a sentence, and what may close after it.
STOPS, CLOSERS = ".!?。！？…؟।:;", "\"'`)]}»”’*_ "
HEADS = {
    "mail_archive": [r"From [0-9a-f]{40}$", r"From: .*>$", rf"Date: {STAMP}$", r"Subject: .+$", r"$"],
    "forge_dump": [r"commit [0-9a-f]{40}$", r"Author: .*>$", rf"Date:   {STAMP}$", r"$"],
    "webhook_log": [r"event: push$", r"sha: [0-9a-f]{40}$", r"author: .*>$", r"message: \|$"],
    "svn_bridge": [rf"r\d+ \| .* \| {STAMP} \| \d+ lines$", r"$"],
    "review_export": [r"# .*$", r"$", r"\*\*Author:\*\* .*>$"],
}
HEADS = {k: [re.compile(x) for x in v] for k, v in HEADS.items()}
SNIFF = (("mail_archive", "From "), ("forge_dump", "commit "), ("webhook_log", "event:"), ("review_export", "# "))
WHOLE, CUT, ASK = 0, 1, 2
DIGITS = str.maketrans("123456789", "0" * 9)
#: Words, parts of joined identifiers, numbers, single marks, line ends.
TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+|[^\W\d_]+|_|\n|[^\s\w]")
#: A text that ends in a token was cut if longer tokens beginning with it occur and it nearly never does (inside a word), or if
#: it occurs and nearly never at a line's end (inside a line): the share seen, and the share that confidence Z leaves possible.
Z = 1.64
MOST_OWN, MAYBE_OWN, MOST_ENDS, MAYBE_ENDS = 0.01, 0.22, 0.0005, 0.027
#: The same after the token before it, for the last lines of diffs.
PAIR_OWN, PAIR_MAYBE_OWN, PAIR_ENDS, PAIR_MAYBE_ENDS = 0.005, 0.052, 0.002, 0.0134
#: Last lines of so many characters or more are looked for among all lines; shorter ones begin many lines by chance.
LINE_PREFIX = 12
#: Lines of encoded bytes, whose tokens say nothing.
BYTES = re.compile(r"(?m)^[ \t]*z\S{60,}\r?$")
#: Tokens are joined by the hash of a prefix of this length, shorter ones by their own.
PREFIX = 3


def layout_of(text: str, source: str | None) -> str:
    """The layout a text is in, by its source or, where that isn't known, by how it begins."""
    if source in HEADS or source == "bundle_import":
        return source
    if re.match(r"r\d+ \|", text):
        return "svn_bridge"
    return next((k for k, head in SNIFF if text.startswith(head)), "bundle_import")


def _binary_end(lines: list[str], i: int) -> tuple[int, int]:
    """After ``GIT binary patch``: where it goes on, and whether it is all there."""
    blocks = 0
    while i < len(lines):
        if not re.fullmatch(r"literal \d+|delta \d+", lines[i]):
            break
        i += 1
        n = 0
        while i < len(lines) and lines[i].strip():
            c, rest = lines[i][0], lines[i][1:]
            size = ord(c) - 64 if "A" <= c <= "Z" else ord(c) - 70 if "a" <= c <= "z" else 0
            if len(rest) != (size + 3) // 4 * 5 or not size:
                return i, CUT
            n += 1
            i += 1
        if not n:
            return i, CUT
        blocks += 1
        while i < len(lines) and not lines[i].strip():
            i += 1
    return i, WHOLE if blocks >= 2 else CUT


def diff_state(lines: list[str], svn: bool) -> tuple[int, str]:
    """Whether a diff is all there; ASK with its last line where only that line may be cut."""
    i, n, last = 0, len(lines), ""
    complete = False
    while i < n:
        line = lines[i]
        if not line.strip():
            i += 1
            continue
        if GIT_FILE.fullmatch(line):
            complete, last = False, line
            i += 1
            while i < n and GIT_MODE.fullmatch(lines[i]):
                i += 1
            if i < n and GIT_INDEX.fullmatch(lines[i]):
                i += 1
            if i < n and lines[i] == "GIT binary patch":
                i, state = _binary_end(lines, i + 1)
                if state == CUT:
                    return CUT, "binary patch"
                complete = True
            elif i < n and lines[i].startswith("Binary files"):
                if not BINARY.fullmatch(lines[i]):
                    return CUT, "file header"
                i, complete = i + 1, True
            continue
        if svn and SVN_FILE.fullmatch(line):
            complete = False
            if i + 1 >= n or len(lines[i + 1]) != 67 or set(lines[i + 1]) != {"="}:
                return CUT, "file header"
            i += 2
            continue
        if line.startswith("--- ") and not complete and (not svn or re.search(r"\t\(revision \d+\)$", line)):
            i += 1
            if i >= n or not lines[i].startswith("+++ ") or (svn and not lines[i].endswith("\t(working copy)")):
                return CUT, "file header"
            i += 1
            continue
        if m := HUNK.match(line):
            old, new = int(m[1] or 1), int(m[2] or 1)
            i += 1
            while (old > 0 or new > 0) and i < n:
                c = lines[i][:1]
                old -= c != "+" and c != "\\"
                new -= c != "-" and c != "\\"
                last = lines[i]
                i += 1
            if old > 0 or new > 0:
                return CUT, "hunk"
            complete = True
            continue
        return CUT, "diff line"
    if complete and last is lines[-1] and not last.strip() and last != " ":
        return CUT, "indent"  # a blank line of a hunk is its mark alone
    return (ASK, last) if complete and last else (WHOLE, "") if complete else (CUT, "file header")


def end_state(text: str, source: str | None) -> tuple[int, str, str]:
    """WHOLE, CUT or ASK with why and, for ASK, the last line: only a look at other texts can tell whether it was cut."""
    layout = layout_of(text, source)
    flat = text.replace("\r\n", "\n")
    if layout == "mail_archive":
        return (WHOLE, "footer", "") if MAIL_END.search(flat.replace("\r", "")) else (CUT, "no footer", "")
    lines = flat.split("\n")
    open_line = lines[-1] != ""  # the text doesn't end with a line end
    if not open_line:
        lines.pop()
    at = 0
    for pattern in HEADS.get(layout, []):
        if at >= len(lines):
            return CUT, "header", ""
        if not pattern.match(lines[at].rstrip("\r")):
            if at == len(lines) - 1:
                return CUT, "header", ""
            break  # a header of another make
        at += 1
    else:
        if at >= len(lines) and layout in ("forge_dump", "webhook_log", "svn_bridge"):
            return CUT, "header", ""
        if at >= len(lines):
            return WHOLE, "header only", ""
    subject_there = layout == "review_export"
    body = lines[at:]
    if layout == "webhook_log":
        patch = next((k for k, x in enumerate(body) if not x.startswith(" ") and x), None)
        if patch is not None:
            if body[patch] != "patch: |":
                return CUT, "header", ""
            diff = [x[2:] if x.startswith("  ") else x for x in body[patch + 1 :]]
            state, why = diff_state(diff, False) if diff else (CUT, "patch")
            return state, *((why, "") if state != ASK else ("last line", why))
        body = [x[2:] if x.startswith("  ") else x for x in body]
    elif layout == "forge_dump":
        body = [x[4:] if x.startswith("    ") else x for x in body]
    svn = layout == "svn_bridge"
    if layout == "review_export":
        fence = next((k for k, x in enumerate(body) if x.rstrip("\r") == "```diff"), None)
        if fence is not None:
            return (WHOLE, "fence", "") if body[-1].rstrip("\r") == "```" and len(body) > fence + 1 else (CUT, "no fence", "")
    if svn and at:
        said = int(re.search(r"(\d+) lines$", lines[0].rstrip("\r"))[1])
        if len(body) < said:
            return CUT, "message lines", ""
        if len(body) > said:
            state, why = diff_state([x.rstrip("\r") for x in body[said:]], True) if any(x.strip() for x in body[said:]) else (WHOLE, "message lines")
            return state, *((why, "") if state != ASK else ("last line", why))
        body = body[:said]
    else:
        begins = next((k for k, x in enumerate(body) if x.startswith("diff --git ") and (k == 0 or not body[k - 1].strip())), None)
        if begins is not None:
            state, why = diff_state([x.rstrip("\r") for x in body[begins:]], False)
            return state, *((why, "") if state != ASK else ("last line", why))
    return message_state(body, open_line, subject_there)


def message_state(body: list[str], open_line: bool, subject_there: bool) -> tuple[int, str, str]:
    """The state of a message that nothing follows."""
    kept = [x.rstrip() for x in body]
    while kept and not kept[-1]:
        kept.pop()
    while kept and not kept[0]:
        kept.pop(0)
    if not kept:
        return WHOLE, "no message", ""
    last = kept[-1]
    if len(kept) == 1 and not subject_there:
        return ASK, "subject", last
    if last.startswith("#"):
        return (ASK, "path", last) if re.match(r"#\t\S+\.\w+$", last) else (CUT, "conflicts", "")
    if last.startswith("Change-Id"):
        return (WHOLE, "trailer", "") if CHANGE.match(last) else (CUT, "trailer", "")
    if TRAILER.match(last) and (len(kept) == 1 or not kept[-2].strip()) or re.match(r"[A-Z][a-z]+-by:|Signed-off", last):
        if "-by:" in last or "@" in last or "<" in last:
            return (WHOLE, "trailer", "") if PERSON.search(last) else (CUT, "trailer", "")
        return ASK, "trailer", last
    if last.rstrip(CLOSERS)[-1:] in STOPS and last.rstrip(CLOSERS):
        return WHOLE, "sentence", ""
    return ASK, "prose", last


def tokens_of(text: str) -> list[str]:
    """Tokens in lower case, with digits as 0."""
    return ["0" if t[0].isdigit() else t for t in TOKEN.findall(text.replace("\r", ""))]


def _states(df: DataFrame, ident: str, text: str, source: str) -> DataFrame:
    """State of each text and, where it may have been cut, its last line and its last token after the one before it."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for d, t, s in zip(pdf["__id"], pdf["__text"], pdf["__source"]):
                state, why, last = end_state(t, s)
                before = token = line = None
                if state == ASK and why == "prose":
                    state = CUT  # a sentence that nothing ends
                elif state == ASK:
                    tail = tokens_of(last.lower() if last.isupper() else last)
                    # a line end or a stop completes the last line
                    if t.endswith("\n") or not tail or tail[-1] in ".!?。！？…":
                        state = WHOLE
                    else:
                        token = tail[-1].lower()
                        if why == "last line":
                            before = tail[-2].lower() if len(tail) > 1 else "\n"
                elif why == "indent" and t.endswith("\n"):
                    state = WHOLE
                if state == CUT:
                    line = t[t.rfind("\n") + 1 :].rstrip("\r").translate(DIGITS)
                    line = line if len(line) >= LINE_PREFIX else None
                    if not t[-1].isspace() and (tail := tokens_of(t[t.rfind("\n") + 1 :][-200:])):  # what its last token says
                        token, before = tail[-1].lower(), tail[-2].lower() if len(tail) > 1 else "\n"
                rows.append((d, s, state, why, before, token, line))
            yield pd.DataFrame(rows, columns=["ident", "source", "state", "why", "before", "token", "line"])

    kind = df.schema[ident].dataType.simpleString()
    there = df.select(F.col(ident).alias("__id"), F.col(text).cast("string").alias("__text"), F.col(source).cast("string").alias("__source"))
    # null, empty and blank texts were not cut
    return there.filter(F.col("__text").rlike(r"\S")).mapInPandas(run, f"ident {kind}, source string, state int, why string, before string, token string, line string")


def _going_on(ends: DataFrame, df: DataFrame, text: str) -> DataFrame:
    """``line``: those of ``ends`` (column ``line``) that are strict prefixes of lines in the texts and no lines themselves.

    All are sorted together by their first LINE_PREFIX characters and then whole, each line once: the strict prefix of any stands
    right before one that goes on from it. Digits count as 0. The last line of each text doesn't count, as it may be cut.
    """
    flat = F.translate(F.regexp_replace(F.col(text).cast("string"), "\r", ""), "123456789", "000000000")
    rows = df.select(F.split(flat, "\n").alias("l")).select(F.explode(F.slice("l", F.lit(1), F.size("l") - 1)).alias("line"))
    lines = rows.filter(F.length("line") >= LINE_PREFIX).select("line", F.lit(True).alias("there"))
    each = lines.unionByName(ends.select("line", F.lit(False).alias("there"))).groupBy("line").agg(F.max("there").alias("there"))
    order = Window.partitionBy(F.substring("line", 1, LINE_PREFIX)).orderBy("line")
    after = each.withColumn("next", F.lead("line").over(order))
    return after.filter(~F.col("there") & F.startswith("next", F.col("line"))).select("line")


def _counts(df: DataFrame, text: str) -> DataFrame:
    """``before, token, ends, goes``: how often each token, after the token before it, ends a line, and how often its line
    goes on, in the whole corpus.

    The last token of each text doesn't count, as it may be cut.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            counts: Counter = Counter()
            for t in pdf["__text"]:
                if "GIT binary patch" in t:
                    t = BYTES.sub("", t)
                tokens = TOKEN.findall(t)
                counts.update(zip(["\n", *tokens], tokens, map("\n".__eq__, tokens[1:])))
            totals: dict[tuple[str, str], list[int]] = {}
            for (before, token, end), n in counts.items():
                if token != "\n":
                    key = ("0" if before[0].isdigit() else before.lower(), "0" if token[0].isdigit() else token.lower())
                    both = totals.get(key)
                    if both is None:
                        both = totals[key] = [0, 0]
                    both[not end] += n
            yield pd.DataFrame([(*k, *v) for k, v in totals.items()], columns=["before", "token", "ends", "goes"])

    there = df.select(F.regexp_replace(F.col(text).cast("string"), "\r", "").alias("__text")).dropna()
    counted = there.mapInPandas(run, "before string, token string, ends long, goes long")
    return counted.groupBy("before", "token").agg(F.sum("ends").alias("ends"), F.sum("goes").alias("goes"))


def _evidence(tails: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """``keys..., ends, goes, longer``: what the corpus says of each tail, joined by a hashed prefix of its last token."""
    prefixes = F.explode(F.transform(F.sequence(F.lit(1), F.least(F.lit(PREFIX), F.length("token"))), lambda n: F.substr(F.col("token"), F.lit(1), n)))
    context = keys[:-1]
    there = seen.select(*context, prefixes.alias("prefix"), F.col("token").alias("other"), "ends", "goes")
    same = F.col("other") == F.col("token")
    return (
        tails.withColumn("prefix", F.substring("token", 1, PREFIX))
        .join(there, [*context, "prefix"])
        .filter(F.col("other").startswith(F.col("token")))
        .groupBy(*keys)
        .agg(
            F.sum(F.when(same, F.col("ends")).otherwise(0)).alias("ends"),
            F.sum(F.when(same, F.col("goes")).otherwise(0)).alias("goes"),
            F.sum(F.when(same, 0).otherwise(F.col("ends") + F.col("goes"))).alias("longer"),
        )
    )


def _at_most(share: float, maybe: float, n: Column, of: Column) -> Column:
    """Whether ``n`` of ``of`` are at most a share, and with confidence at most another."""
    m = F.greatest(of, F.lit(1))
    p = n / m
    upper = (p + Z * Z / (2 * m) + Z * F.sqrt(p * (1 - p) / m + Z * Z / (4 * m * m))) / (1 + Z * Z / m)
    return (of > 0) & (p <= share) & (upper <= maybe)


def _judged(evidence: DataFrame, keys: list[str], name: str, own: float, maybe_own: float, ends: float, maybe_ends: float) -> DataFrame:
    all_own = F.col("ends") + F.col("goes")
    inside_word = (F.col("longer") > 0) & _at_most(own, maybe_own, all_own, all_own + F.col("longer"))
    inside_line = (F.col("goes") > 0) & _at_most(ends, maybe_ends, F.col("ends"), all_own)
    return evidence.select(*keys, F.when(inside_word, F.lit("inside a word")).when(inside_line, F.lit("inside a line")).alias(name)).dropna(subset=[name])


def truncated(df: DataFrame, ident: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``ident, source, cut, why`` of each text with content, ``cut`` being whether it was cut before its end.

    ``why`` says how it was found. "line goes on": its last line is a strict prefix of a longer line elsewhere and no line
    itself. "inside a word": its last token is a strict prefix of longer tokens and nearly never a token itself; "inside a line": lines
    nearly never end in it; in diffs the same is asked of the last token after the one before it. Anything else: only the form of
    the text, by which hunk headers say how many lines follow, svn headers how long the message is, mails and exports have an end
    mark, sentences a stop. The form also rejects what the corpus suggests: a text whose form is complete is whole, and of
    one whose last line alone may be cut only tokens decide. Null, empty and blank texts give no row; texts of no known
    layout are taken as messages; rows repeated give repeated rows.
    """
    states = staged(_states(df, ident, text, source))
    pairs = staged(_counts(df, text))
    tokens = pairs.groupBy("token").agg(F.sum("ends").alias("ends"), F.sum("goes").alias("goes"))
    tails = states.filter("token is not null")
    alone = _judged(_evidence(tails.select("token").distinct(), tokens, ["token"]), ["token"], "alone", MOST_OWN, MAYBE_OWN, MOST_ENDS, MAYBE_ENDS)
    keys = ["before", "token"]
    after = _judged(_evidence(tails.filter("before is not null").select(*keys).distinct(), pairs, keys), keys, "after", PAIR_OWN, PAIR_MAYBE_OWN, PAIR_ENDS, PAIR_MAYBE_ENDS)
    going = _going_on(states.select("line").dropna().distinct(), df, text).withColumn("line_why", F.lit("line goes on"))
    out = states.join(alone, "token", "left").join(after, keys, "left").join(going, "line", "left").withColumn("tail", F.coalesce("line_why", "alone", "after"))
    return out.select(
        F.col("ident").alias(ident),
        "source",
        ((F.col("state") == CUT) | F.col("tail").isNotNull()).alias("cut"),
        F.coalesce("tail", F.when(F.col("state") == CUT, F.col("why")), F.lit("whole")).alias("why"),
    )


def rates(df: DataFrame, ident: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``source, texts, cut_texts, cut_share`` for each source; a null source is a group of its own."""
    found = truncated(df, ident, text, source)
    cut = F.count_if("cut")
    return found.groupBy("source").agg(F.count("*").alias("texts"), cut.alias("cut_texts"), F.round(cut / F.count("*"), 6).alias("cut_share"))
