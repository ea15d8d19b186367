"""The chunking, completeness and merge rules in plain Python, stated from the
survey's rules, for comparison with the DataFrame operators."""

import json
from bisect import bisect_right

from chunkwright.params import MAP_SECTIONS as MAPS, NONE_LIKE as NONE, TEXT_SECTIONS as TEXT


def word_chunks(text: str, m: int) -> list[str]:
    """A chunk ends at the last break at most m characters on (the break opens
    the next chunk), or after m characters where there is none."""
    breaks = [i for i, c in enumerate(text) if c in " \n"]
    bounds = [0]
    while bounds[-1] + m < len(text):
        low = bounds[-1]
        k = bisect_right(breaks, low + m)
        bounds.append(breaks[k - 1] if k and breaks[k - 1] > low else low + m)
    return [text[a:b] for a, b in zip(bounds, bounds[1:] + [len(text)])] if text else []


def line_chunks(text: str, m: int) -> list[str]:
    """As many whole lines as fit; a longer line is cut every m characters."""
    *lines, last = text.split("\n")
    out, chunk = [], ""
    for line in [x + "\n" for x in lines] + [last]:
        if chunk and len(chunk + line) > m:
            out.append(chunk)
            chunk = ""
        chunk += line
        while len(chunk) > m:
            out.append(chunk[:m])
            chunk = chunk[m:]
    return out + [chunk] if chunk else out


def json_incomplete(answer: str) -> bool:
    """Whether a non-blank answer does not end with a brace, or opens and
    closes a different number of them."""
    balance, last = 0, "}"
    for c in answer.strip():
        balance += (c == "{") - (c == "}")
        last = c
    return balance != 0 or last != "}"


def stripped(value):
    """value with the strings at every depth stripped, names kept as they are:
    a copy, and a list of the containers still to look into."""
    box = [json.loads(json.dumps(value))]
    waiting = [box]
    while waiting:
        holder = waiting.pop()
        for place in list(holder) if isinstance(holder, dict) else range(len(holder)):
            if isinstance(holder[place], str):
                holder[place] = holder[place].strip()
            elif isinstance(holder[place], (list, dict)):
                waiting.append(holder[place])
    return box[0]


def as_text(value) -> str:
    return value if isinstance(value, str) else json.dumps(value, separators=(",", ":"), ensure_ascii=False)


def merge_records(records: list[dict]):
    """(text by section, items by section) of the records in chunk order: text
    is the ordered set of its ", " fragments, the first value of an item wins."""
    fragments = {k: {} for k in TEXT}
    maps = {k: {} for k in MAPS}
    for record in map(stripped, records):
        for section in TEXT:
            value = record.get(section)
            if isinstance(value, str) and value.lower() not in NONE:
                fragments[section].update(dict.fromkeys(value.split(", ")))
        for section in MAPS:
            items = record.get(section)
            for name, value in items.items() if isinstance(items, dict) else ():
                if as_text(value).lower() not in NONE:
                    maps[section].setdefault(name, as_text(value))
    return {k: ", ".join(v).rstrip(", ") for k, v in fragments.items()}, maps
