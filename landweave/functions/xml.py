"""Values of XML texts by path. Texts with the same tags are laid out alike: one of them is parsed, the others' values are cut out by place.

A path is what ElementTree's `find` takes, namespaces left out, and may end with an attribute: `a/b[@k='v']/c`, `a/b/@x`.
"""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

_SPACE = " \t\r\n"


def _root(text: bytes) -> ET.Element | None:
    try:
        return ET.fromstring(text.decode("utf-8", "replace"))
    except (ET.ParseError, ValueError, LookupError):
        return None


def _value(e: ET.Element | None, attribute: str) -> str | None:
    value = None if e is None else e.get(attribute) if attribute else e.text or ""
    return value if value is None else value.strip(_SPACE)


def _layout(root: ET.Element, tokens: list[bytes], finds: list) -> list[tuple[int, str | None]] | None:
    """For each path the token that holds its value in all texts of these tags, or -1 and the value that they share; None if it can't be told."""
    tags = [i for i, t in enumerate(tokens) if t[:1] == b"<" and t[:2] not in (b"</", b"<?")]
    if any(b"'" in tokens[i] or tokens[i][:2] == b"<!" for i in tags) or any(t[:2] == b"<?" for t in tokens[1:]):
        return None  # comments, sections, types, instructions; values in single quotes may look like attributes
    at = {e: tags[k] for k, e in enumerate(root.iter())}
    out = []
    for path, attribute in finds:
        e = root.find(path)
        held = e is not None and (re.search(rf'[ \n]{attribute}="[^"\n]*"'.encode(), tokens[at[e]]) if attribute else not tokens[at[e]].endswith(b"/"))
        out.append((at[e] + (not attribute), None) if held else (-1, _value(e, attribute)))
    return out


def _plain(data: np.ndarray, begin: np.ndarray, end: np.ndarray, marks: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which texts are ASCII without references and control characters, with `<` and `>` in turn, from the first to the last but a line's end."""
    plain = end > begin
    odd = np.flatnonzero(((data < 32) & (data != 10)) | (data > 126) | (data == 38))
    plain[np.searchsorted(end, odd, "right")] = False
    same = np.flatnonzero((data[marks[1:]] == data[marks[:-1]]) & (of[1:] == of[:-1]))
    plain[of[same]] = False
    some = np.flatnonzero(plain)
    last = end[some] - 1
    last = last - ((data[last] == 10) & (last > begin[some]))
    plain[some] = (data[begin[some]] == 60) & (data[last] == 62)
    return plain


def _values(texts: pa.Array, paths: list[str]) -> tuple[list[pa.Array], np.ndarray]:
    """An array for each path, of the first element's value that it leads to (null: none is), and which texts are well-formed."""
    split = [p.partition("/@") for p in paths]
    finds = [("/".join("{*}" + s for s in p.split("/")), attribute) for p, _, attribute in split]
    texts = texts.cast(pa.binary())
    asked, wanted = set(re.findall(r"@(\w+)=", " ".join(paths))), {a for _, a in finds if a}
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    content = texts.buffers()[2] or pa.py_buffer(b"")
    data = np.frombuffer(content, np.uint8)[: offsets[-1]]
    begin, end = offsets[:-1], offsets[1:]
    marks = np.flatnonzero((data == 60) | (data == 62))
    marks = marks[marks >= offsets[0]].astype(np.int32)
    of = np.searchsorted(end, marks, "right")
    plain = _plain(data, begin, end, marks, of)
    tokens = pa.Array.from_buffers(pa.binary(), len(marks), [None, pa.py_buffer(np.append(marks, offsets[-1]).astype(np.int32)), content])
    coded = tokens.dictionary_encode()
    # a tag without the values that are cut out, a text as blank or not: equal forms in turn are one layout
    forms = pc.if_else(pc.starts_with(coded.dictionary, b"<"), coded.dictionary, pc.replace_substring_regex(coded.dictionary, r"^>[ \n]*[^ \n](?s:.*)$", ">."))
    forms = pc.if_else(pc.starts_with(forms, b"<"), forms, pc.replace_substring_regex(forms, r"^>[ \n]*$", ">"))
    if wanted - asked:
        forms = pc.replace_substring_regex(forms, rf'([ \n](?:{"|".join(sorted(wanted - asked))})=")[^"\n]*"', r'\1"')
    codes = forms.dictionary_encode().indices.to_numpy()[coded.indices.to_numpy()]
    first = np.searchsorted(of, np.arange(len(texts) + 1))
    layouts: dict[bytes, list[int]] = {}
    singly = []
    for i in range(len(texts)):
        if plain[i]:
            layouts.setdefault(codes[first[i] : first[i + 1]].tobytes(), []).append(i)
        elif texts[i].is_valid:
            singly.append(i)
    whole, rows, parts = np.zeros(len(texts), bool), [], [[] for _ in finds]
    for alike in layouts.values():
        i = alike[0]
        root = _root(texts[i].as_py())
        if root is None:
            continue
        layout = _layout(root, tokens[first[i] : first[i + 1]].to_pylist(), finds)
        if layout is None:
            singly += alike
            continue
        rows.append(np.array(alike))
        for part, (place, value), (_, attribute) in zip(parts, layout, finds):
            if place < 0:
                part.append(pa.array([value] * len(alike), pa.string()))
                continue
            held = tokens.take(pa.array(first[rows[-1]] + place)).cast(pa.string())
            held = pc.struct_field(pc.extract_regex(held, rf'[ \n]{attribute}="(?P<v>[^"\n]*)"'), "v") if attribute else pc.utf8_slice_codeunits(held, 1)
            part.append(pc.utf8_trim(held, characters=_SPACE))
    roots = [(i, r) for i in singly if (r := _root(texts[i].as_py())) is not None]
    rows.append(np.array([i for i, _ in roots], int))
    for part, (path, attribute) in zip(parts, finds):
        part.append(pa.array([_value(r.find(path), attribute) for _, r in roots], pa.string()))
    at = np.concatenate(rows)
    whole[at] = True
    back = np.full(len(texts), -1)
    back[at] = np.arange(len(at))
    back = pa.array(back, mask=back < 0)
    return [pa.concat_arrays(part).take(back) for part in parts], whole


def xml_values(content: Column, paths: dict[str, str]) -> Column:
    """A struct of strings, a value for each path (name -> path); null for a text that is not well-formed."""
    names = list(paths)

    @F.arrow_udf(", ".join(f"`{n}` string" for n in names))
    def values(texts: pa.Array) -> pa.Array:
        columns, whole = _values(texts, list(paths.values()))
        return pa.StructArray.from_arrays(columns, names, mask=pa.array(~whole))

    return values(content.cast("binary"))
