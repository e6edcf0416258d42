"""YAML documents as rows of JSON text (SRC-6).

Spark's text source cuts files at lines that begin with ``---`` (``lineSep``), so a document is a row
and a large file is split over many tasks; no file is read as a whole. Each document is parsed in its
task into JSON text, the shape that ``from_json`` reads; one that can't be parsed is a row
with an error and its text.

Read are the block and flow styles of mappings and sequences, plain, quoted, literal
and folded scalars, comments, and the YAML 1.1 words for null and booleans. Anchors, aliases, tags,
merge keys and explicit keys (``?``) are errors by name, not guesses. A repeated key: the last one wins.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparksweep.session import ship_package

# fixed values: the words of YAML 1.1
WORDS = {"": None, "~": None, "null": None, "Null": None, "NULL": None,
         **{w: True for x in ("true", "yes", "on") for w in (x, x.title(), x.upper())},
         **{w: False for x in ("false", "no", "off") for w in (x, x.title(), x.upper())}}
ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "0": "\0", "a": "\a", "b": "\b", "e": "\x1b", "f": "\f", "v": "\v",
           " ": " ", '"': '"', "\\": "\\", "/": "/", "N": "\x85", "_": "\xa0", "L": "\u2028", "P": "\u2029"}
NUMBER = re.compile(r"[-+]?(0|[1-9][0-9_]*)$|[-+]?0x[0-9a-fA-F_]+$|[-+]?0[0-7_]+$|[-+]?0b[01_]+$")
REAL = re.compile(r"[-+]?([0-9][0-9_]*\.[0-9_]*|\.[0-9][0-9_]*)([eE][-+][0-9]+)?$")
SPECIAL = re.compile(r"[-+]?\.(inf|Inf|INF)$|\.(nan|NaN|NAN)$")
KEY = re.compile(r"""("(?:[^"\\]|\\.)*"|'(?:[^']|'')*'|[^\s\-?:,\[\]{}#&*!|>'"%@`](?:[^:#]|:(?=\S)|(?<=\S)#)*|[-?:](?=\S)(?:[^:#]|:(?=\S)|(?<=\S)#)*?)\s*:(?=\s|$)""")
UNREAD = {"&": "anchor", "*": "alias", "!": "tag", "?": "explicit key", "@": "reserved character", "`": "reserved character", "%": "directive"}
HEAD = re.compile(r"([|>])([-+]?)([1-9]?)([-+]?)\s*(?:#.*)?$")


class YamlError(ValueError):
    pass


def scalar(text: str):
    """The value of a plain scalar."""
    if text in WORDS:
        return WORDS[text]
    bare = text.replace("_", "")
    if NUMBER.match(text):
        sign, digits = (-1 if bare[0] == "-" else 1), bare.lstrip("+-")
        base = 16 if digits[:2] == "0x" else 2 if digits[:2] == "0b" else 8 if digits[0] == "0" and len(digits) > 1 else 10
        return sign * int(digits[2:] if base in (2, 16) else digits, base)
    if REAL.match(text):
        return float(bare)
    return text  # .inf and .nan have no JSON number: kept as text


class Flow:
    """Flow collections and quoted scalars in one text."""

    def __init__(self, text: str):
        self.text, self.at = text, 0

    def skip(self) -> str:
        while m := re.compile(r"\s+(#[^\n]*)?").match(self.text, self.at):
            self.at = m.end()
        return self.text[self.at: self.at + 1]

    def quoted(self) -> str:
        q = self.text[self.at]
        m = re.compile(r'"((?:[^"\\]|\\.)*)"' if q == '"' else r"'((?:[^']|'')*)'", re.S).match(self.text, self.at)
        if not m:
            raise YamlError("quoted text has no end")
        self.at = m.end()
        fold = r"[ \t]*\n(?:[ \t]*\n)*[ \t]*"  # a line break is a space, n + 1 of them are n line breaks

        def one(m: re.Match) -> str:
            found = m[0]
            if "\n" in found and found[0] != "\\":
                return "\n" * (found.count("\n") - 1) or " "
            if found == "''":
                return "'"
            if found[:2] == "\\\n":  # joins the lines
                return ""
            if found[1] in "xuU" and len(found) > 2:
                return chr(int(found[2:], 16))
            if found[1:] not in ESCAPES:
                raise YamlError(f"unknown escape {found}")
            return ESCAPES[found[1:]]

        if q == "'":
            return re.sub(fold + "|''", one, m[1])
        return re.sub(fold + r"|\\\n[ \t]*|\\(?:x[0-9a-fA-F]{2}|u[0-9a-fA-F]{4}|U[0-9a-fA-F]{8}|.)", one, m[1])

    def value(self):
        c = self.skip()
        if c and c in '"\'':
            return self.quoted()
        if c in UNREAD:
            raise YamlError(f"{UNREAD[c]} is not read")
        if c not in ("[", "{"):
            m = re.compile(r"(?:[^,\[\]{}:#]|:(?=[^\s,\[\]{}])|(?<=\S)#)*").match(self.text, self.at)
            self.at = m.end()
            return scalar(re.sub(r"\s*\n\s*", " ", m[0].strip()))
        self.at += 1
        out, end = ({}, "}") if c == "{" else ([], "]")
        while (now := self.skip()) != end:
            if not now or now == ",":
                raise YamlError("flow collection has no end" if not now else "empty flow entry")
            item = self.value()
            colon = self.skip() == ":"
            if colon:
                self.at += 1
            if c == "{":
                out[text_key(item)] = self.value() if colon else None
            else:
                out.append({text_key(item): self.value()} if colon else item)
            if self.skip() == ",":
                self.at += 1
            elif self.skip() != end:
                raise YamlError("flow collection has no end")
        self.at += 1
        return out


def text_key(key) -> str:
    if isinstance(key, (dict, list)):
        raise YamlError("a collection as a key is not read")
    return key if isinstance(key, str) else json.dumps(key)


class Block:
    """The block structure of a document, by indentation."""

    def __init__(self, text: str):
        self.lines = [x.rstrip("\r") for x in text.removesuffix("\n").split("\n")]
        self.at = 0

    def peek(self) -> tuple[int, str]:
        """Indentation and content of the next line that has any; (-1, "") at the end."""
        while self.at < len(self.lines):
            line = self.lines[self.at]
            body = line.lstrip(" ")
            if body.startswith("\t") and body.strip() and not body.strip().startswith("#"):
                raise YamlError("tab in an indentation")
            if body.strip() and not body.startswith("#"):
                return (-1, "") if line.rstrip() == "..." else (len(line) - len(body), body.rstrip())
            self.at += 1
        return -1, ""

    def node(self, least: int):
        """The node that starts at the next line, indented by ``least`` or more; None if there is none."""
        indent, body = self.peek()
        if indent < least:
            return None
        if body == "-" or body.startswith("- "):
            return self.sequence(indent)
        if KEY.match(body):
            return self.mapping(indent)
        self.at += 1
        return self.inline(body, least - 1)

    def sequence(self, indent: int) -> list:
        out = []
        while True:
            now, body = self.peek()
            if now != indent or not (body == "-" or body.startswith("- ")):
                return out
            rest = body[1:].lstrip(" ")
            if not rest or rest.startswith("#"):
                self.at += 1
                out.append(self.node(indent + 1))
            elif rest == "-" or rest.startswith("- ") or KEY.match(rest):  # a collection that starts on this line
                self.lines[self.at] = " " * (indent + len(body) - len(rest)) + rest
                out.append(self.node(indent + 1))
            else:
                self.at += 1
                out.append(self.inline(rest, indent))

    def mapping(self, indent: int) -> dict:
        out: dict = {}
        while True:
            now, body = self.peek()
            m = KEY.match(body) if now == indent else None
            if not m:
                return out
            key = Flow(m[1]).quoted() if m[1][0] in "\"'" else text_key(scalar(m[1].strip()))
            if key == "<<":
                raise YamlError("merge key is not read")
            rest = body[m.end():].lstrip()
            self.at += 1
            if rest and not rest.startswith("#"):
                out[key] = self.inline(rest, indent)
                continue
            deeper, following = self.peek()
            same = deeper == indent and (following == "-" or following.startswith("- "))
            out[key] = self.sequence(indent) if same else self.node(indent + 1)

    def inline(self, rest: str, indent: int):
        """The value that starts behind a key or a dash, with its further lines (deeper than ``indent``)."""
        if rest[0] in UNREAD:
            raise YamlError(f"{UNREAD[rest[0]]} is not read")
        if m := HEAD.match(rest):
            return self.literal(m[1] == "|", m[2] or m[4], int(m[3]) if m[3] else 0, indent)
        if rest[0] in "\"'[{":
            while True:
                flow = Flow(rest)
                try:
                    value = flow.value()
                    break
                except YamlError as e:
                    if "has no end" not in str(e) or self.at >= len(self.lines):
                        raise
                    rest += "\n" + self.lines[self.at]
                    self.at += 1
            if flow.skip():
                raise YamlError("text behind a closed value")
            return value
        if rest == "-" or rest.startswith("- "):
            raise YamlError("a sequence can't start behind a key")
        parts = [re.split(r"\s#", rest, maxsplit=1)[0].rstrip()]
        while "#" not in rest and self.peek()[0] > indent:  # a plain scalar goes on in deeper lines
            rest = self.peek()[1]
            if KEY.match(rest):
                raise YamlError(f"line {self.at + 1}: a mapping inside a plain text")
            parts.append(re.split(r"\s#", rest, maxsplit=1)[0].rstrip())
            self.at += 1
        if re.search(r":(\s|$)", " ".join(parts)):
            raise YamlError("': ' inside a plain text")
        return scalar(" ".join(parts))

    def literal(self, keep_lines: bool, chomp: str, extra: int, indent: int) -> str:
        held, before = [], ""
        width = max(indent, 0) + extra if extra else 0
        while self.at < len(self.lines):
            line = self.lines[self.at]
            depth = len(line) - len(line.lstrip(" "))
            if line.strip():
                width = width or depth
                if depth < width or depth <= indent:
                    break
            held.append(line[width:] if line.strip() or len(line) > width > 0 else "")
            self.at += 1
        full = len(held)
        while full and not held[full - 1]:
            full -= 1
        body, blank = "", 0
        for k, line in enumerate(held[:full]):
            if keep_lines:
                body += "\n" * (k > 0) + line
            elif not line:
                blank += 1
            else:  # a single line break is a space, but not beside an indented line
                more = body and (line[0] in " \t" or before[0] in " \t")
                body += ("\n" * (blank + bool(more)) if blank or more else " " * bool(body)) + line
                before, blank = line, 0
        return body + ("" if chomp == "-" else "\n" * (len(held) - full + bool(full)) if chomp == "+" else "\n" * bool(full))


def parse(text: str):
    """The value of one document; YamlError if it can't be read."""
    block = Block(text)
    value = block.node(0)
    if block.peek()[0] >= 0:
        raise YamlError(f"line {block.at + 1} fits no level")
    return value


def read_documents(spark: SparkSession, path: str, glob: str | None = "*.yaml") -> DataFrame:
    """(file_path, at, line_no, raw, doc, error): a row per document with something in it, in the order
    (file_path, at, line_no); doc is its JSON text, or null with the error."""
    import pyarrow as pa

    ship_package(spark)
    reader = spark.read.option("lineSep", "\n---")
    cut = (reader.option("pathGlobFilter", glob) if glob else reader).text(path).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().alias("line_no"), F.col("value").alias("raw"))
    # the first document may begin with the marker itself; records of comments or directives alone are none
    body = F.regexp_replace(F.regexp_replace("raw", r"^\x{FEFF}", ""), r"\A---", "")
    some = cut.withColumn("body", body).where(F.col("body").rlike(r"(?m)^[ \t]*[^\s#%]"))

    def one(raw: str) -> tuple[str | None, str | None]:
        try:
            return json.dumps(parse(raw), ensure_ascii=False), None
        except (YamlError, RecursionError) as e:
            return None, f"malformed YAML: {e}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, error = zip(*map(one, batch.column("body").to_pylist()), strict=True) if batch.num_rows else ((), ())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("file_path", "at", "line_no", "raw")],
                                              pa.array(doc, pa.string()), pa.array(error, pa.string())],
                                             ["file_path", "at", "line_no", "raw", "doc", "error"])

    return some.mapInArrow(run, "file_path string, at long, line_no long, raw string, doc string, error string")
