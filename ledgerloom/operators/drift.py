"""Schemas that drift between the files of a registry: changes, and one consistent table.

A file's schema is profiled in Spark; then each file is matched with the one
before it by similarity flooding (Melnik et al., 2002): both schemas become
graphs of field, type, nesting and value nodes, scores of node pairs flow along
equally labelled edges until they settle, and the mutually best pairs of a
vanished and a new field are renames if their contents agree.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import settled

#: Types of a JSON value, in the order that settles ties.
KINDS = ["string", "number", "boolean", "array", "object"]
#: Hash functions of each of a field's two value sketches; the error of an estimated overlap is below 0.1.
SKETCH = 32
#: Share of values in which two fields' contents agree (estimated Jaccard similarity) from which they may be one field,
#: and where there are hardly any different values, so that fields agree by chance. Records come and go between files, and
#: are compared as they stand, so that the share is well below 1; different contents share next to nothing. Twice the
#: share counts as full agreement.
SAME_CONTENT, SAME_CONTENT_OF_FLAGS, FLAG_VALUES = 0.1, 0.4, 3
#: What name and content give a pair of fields to start with, what part of a shared type's score comes back to it, and
#: the part of an equal pair's settled score from which a pair is a rename.
BY_NAME, BY_CONTENT, BY_TYPE, RENAMED = 0.1, 0.9, 0.1, 0.4
#: Below this many different values, agreement counts only record by record.
FEW_VALUES = 24
ROUNDS = 60
#: Columns a unified table may have: payloads whose keys are data would make more.
MOST_FIELDS = 5_000
EPSILON = 1e-4

CHANGES = "source_dataset_id string, file_seq int, change_kind string, field_name string, new_name string"


def json_fields(records: DataFrame, keep: list[str], payload: str = "payload", with_shape: bool = False) -> DataFrame:
    """One row per top-level field of each readable record: ``keep``, field, kind, text (and ``shape``, the type of a nested value, else '').

    kind is NULL for a JSON null. Unreadable payloads (broken, NULL, no object,
    or with a repeated name) give no rows.
    """
    spark = records.sparkSession
    parsed = records.select(*keep, F.try_parse_json(F.col(payload)).alias("_json"))
    fields = parsed.lateralJoin(spark.tvf.variant_explode(F.col("_json").outer())).where("key is not null")
    shape = F.schema_of_variant("value")
    kind = (
        F.when(shape == "VOID", F.lit(None))
        .when(shape == "STRING", "string")
        .when(shape == "BOOLEAN", "boolean")
        .when(shape.startswith("ARRAY"), "array")
        .when(shape.startswith("OBJECT"), "object")
        .otherwise("number")
    )
    return fields.select(*keep, F.col("key").alias("field"), kind.alias("kind"), F.try_variant_get("value", "$", "string").alias("text"), *([F.when(kind.isin("array", "object"), shape).otherwise("").alias("shape")] if with_shape else []))


def _tokens(text: Column) -> Column:
    """The leaf values of a field, whether it is a scalar, an array or an object."""
    parts = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), r'[\[\]{}"]', ""), r"\s*[,:]\s*")
    return F.filter(F.transform(parts, F.trim), lambda t: t != "")


def profiles(records: DataFrame) -> DataFrame:
    """One row per field of a file: type counts, its type, and two sketches of its values.

    Records are profiled as (source_dataset_id, file_seq, payload); other
    columns are ignored. ``held`` is the type, or the last one known where all
    values are null; ``shape`` is the type of its nested values, the last in order if they differ. ``seen`` holds minima of hashed values, ``placed`` those of
    values together with the record they stand in; both merge by minimum, so
    Spark aggregates them before the shuffle and a file of any size costs
    2 x SKETCH numbers.
    """
    file = ["source_dataset_id", "file_seq"]
    # A record comes again with most of its values: the least hash of its longer values identifies it.
    values = F.map_values(F.from_json("payload", "map<string,string>"))
    long = F.filter(values, lambda v: (F.length(v) >= 6) & ~v.rlike(r"^[\[{]"))
    anchor = F.array_min(F.transform(long, lambda v: F.xxhash64(v))).alias("anchor")
    fields = json_fields(records.select(*file, "payload", anchor), [*file, "anchor"], with_shape=True)
    rows = fields.withColumn("tokens", _tokens(F.col("text")))
    rows = rows.withColumns({"one": F.when(F.size("tokens") == 1, F.xxhash64(F.get("tokens", F.lit(0)))), "many": F.when(F.size("tokens") > 1, F.transform("tokens", lambda t: F.xxhash64(t)))})
    # Most values are one token, which needs no loop over an array.
    hashed = lambda i, *also: F.when(F.col("one").isNotNull(), F.xxhash64("one", F.lit(i), *also)).otherwise(F.array_min(F.transform("many", lambda t: F.xxhash64(t, F.lit(i), *also))))
    counts = [F.count_if(F.col("kind") == k).alias(k) for k in KINDS]
    seen = [F.min(hashed(i)).alias(f"s{i}") for i in range(SKETCH)]
    placed = [F.min(F.when(F.col("anchor").isNotNull(), hashed(i, F.col("anchor")))).alias(f"p{i}") for i in range(SKETCH)]
    per_field = rows.groupBy(*file, "field", "shape").agg(*counts, F.approx_count_distinct("text").alias("values"), *seen, *placed)
    # Numbers only so far, which Spark aggregates by hash; a field's few shapes are merged afterwards.
    least = [F.min(f"{s}{i}").alias(f"{s}{i}") for s in "sp" for i in range(SKETCH)]
    per_field = per_field.groupBy(*file, "field").agg(*(F.sum(c).alias(c) for c in (*KINDS, "values")), F.max("shape").alias("shape"), *least)
    best = F.greatest(*KINDS)
    kind = F.when(best > 0, F.coalesce(*(F.when(F.col(k) == best, F.lit(k)) for k in KINDS)))
    history = W.partitionBy("source_dataset_id", "field").orderBy("file_seq")
    return per_field.select(
        *file, "field", kind.alias("kind"), "values", "shape",
        F.last(kind, ignorenulls=True).over(history).alias("held"),
        F.array(*(f"s{i}" for i in range(SKETCH))).alias("seen"),
        F.array(*(f"p{i}" for i in range(SKETCH))).alias("placed"),
    )


def _pieces(name: str) -> set[str]:
    s = "".join(c for c in name.lower() if c.isalnum())
    return {s[i : i + 2] for i in range(len(s) - 1)} or {s}


def _alike(a: str, b: str) -> float:
    x, y = _pieces(a), _pieces(b)
    return 2 * len(x & y) / (len(x) + len(y))


def _agreement(a, b) -> float:
    both = [(x, y) for x, y in zip(a, b, strict=True) if x is not None and y is not None and x == x and y == y]
    return sum(x == y for x, y in both) / len(a) if both else 0.0


def _content(a, b) -> float:
    """How much two fields' values agree: record by record, or as sets where there are enough of them."""
    return max(_agreement(a.placed, b.placed), _agreement(a.seen, b.seen) if min(a.values, b.values) >= FEW_VALUES else 0.0)


def nested(shape: str | None) -> tuple[str, list[tuple[str, str]]]:
    """(kind, [(name, shape)] of what is nested) of a type as Spark writes it; an array's element is named '[]'."""
    text = (shape or "").strip()
    head, _, rest = text.partition("<")
    inner = rest[: rest.rindex(">")] if ">" in rest else ""
    kind = {"ARRAY": "array", "OBJECT": "object", "STRUCT": "object", "STRING": "string", "BOOLEAN": "boolean", "VOID": "null", "": "null", "VARIANT": "mixed"}.get(head, "number")
    if kind == "array":
        return kind, [("[]", inner)]
    parts, depth, quoted, start = [], 0, False, 0
    for i, ch in enumerate(inner + ","):
        if ch == "`":
            quoted = not quoted
        elif not quoted:
            depth += (ch in "<(") - (ch in ">)")
            if ch == "," and depth == 0:
                parts.append(inner[start:i])
                start = i + 1
    named = [p.strip() for p in parts if p.strip()] if kind == "object" else []
    cut = [p.rindex("`:") + 1 if p.startswith("`") and "`:" in p else p.index(":") for p in named if ":" in p]
    return kind, [(p[:c].strip("`"), p[c + 1 :]) for p, c in zip((p for p in named if ":" in p), cut, strict=True)]


ROOT, EQUAL = (), ("equal",)


def _graph(fields: dict) -> dict[tuple, tuple[str, list[tuple]]]:
    """path -> (kind, paths nested in it) of a record, its fields and all that is nested in them."""
    out: dict[tuple, tuple[str, list[tuple]]] = {ROOT: ("record", [(f,) for f in fields])}
    waiting = [((f,), getattr(p, "shape", None), p.held) for f, p in fields.items()]
    while waiting:
        path, shape, held = waiting.pop()
        kind, inner = nested(shape)
        out[path] = (held or kind, [(*path, name) for name, _ in inner])
        waiting += [((*path, name), s, None) for name, s in inner]
    return out


def flood(old: dict, new: dict) -> dict[tuple[str, str], float]:
    """Settled scores of all pairs (old field, new field), as parts of that of a pair equal in name and content without neighbours.

    Nodes of the pairwise graph are pairs of records, fields, nested parts (of
    paired parents) and types; edges say 'has' and 'is of type', both ways. A
    node hands its score on in equal parts to all its neighbours of one label. Scores start
    from names and contents; nested parts from names, types from equality.
    """
    a, b = _graph(old), _graph(new)
    start: dict[tuple, float] = {(ROOT, ROOT): 1.0, EQUAL: BY_NAME + BY_CONTENT}
    flows: dict[tuple, list[tuple[tuple, float]]] = defaultdict(list)  # node -> [(from, share)]
    of_kind: dict[tuple, list[tuple]] = defaultdict(list)
    waiting = [(ROOT, ROOT)]
    while waiting:
        x, y = waiting.pop()
        kinds = ("type", a[x][0], b[y][0])
        start.setdefault(kinds, float(kinds[1] == kinds[2]))
        of_kind[kinds].append((x, y))
        children = [(u, v) for u in a[x][1] for v in b[y][1]]
        for u, v in children:
            if len(u) == 1:
                start[u, v] = BY_NAME * _alike(u[0], v[0]) + BY_CONTENT * _same(old[u[0]], new[v[0]])
            else:
                start[u, v] = BY_NAME * _alike(u[-1], v[-1])
            flows[u, v].append(((x, y), 1.0 / len(children)))
            flows[x, y].append(((u, v), 1.0 / len(children) if x == ROOT else BY_NAME))
        waiting += children
    for kinds, pairs in of_kind.items():
        for pair in pairs:
            flows[kinds].append((pair, 1.0 / len(pairs)))
            flows[pair].append((kinds, BY_TYPE / len(pairs)))
    score = dict(start)
    for _ in range(ROUNDS):
        held = {n: start[n] + score[n] for n in score}
        nxt = {n: held[n] + sum(share * held[m] for m, share in flows[n]) for n in score}
        top = max(nxt.values()) or 1.0
        nxt = {n: v / top for n, v in nxt.items()}
        done = max(abs(nxt[n] - score[n]) for n in nxt) < EPSILON
        score = nxt
        if done:
            break
    return {(x, y): score[(x,), (y,)] / score[EQUAL] for x in old for y in new}


def _same(p, q) -> float:
    """How far two fields' contents speak for one field: 0.5 at the share from which they may be one, at most 1."""
    least = SAME_CONTENT if max(p.values, q.values) > FLAG_VALUES else SAME_CONTENT_OF_FLAGS
    return min(1.0, _content(p, q) / (2 * least))


def renames(old: dict, new: dict) -> dict[str, str]:
    """Vanished fields that go on under a new name, one to one: pairs that are each other's best by the settled scores, from RENAMED on."""
    gone, come = [a for a in old if a not in new], [b for b in new if b not in old]
    if not gone or not come:
        return {}
    score = flood(old, new)
    out: dict[str, str] = {}
    for a, b in sorted(((a, b) for a in gone for b in come), key=lambda p: (-score[p], p)):
        if a not in out and b not in out.values() and score[a, b] >= RENAMED:
            out[a] = b
    return out


def _compare(rows: pd.DataFrame) -> pd.DataFrame:
    source, seq = rows.source_dataset_id.iloc[0], int(rows.at_seq.iloc[0])
    side = {s: {r.field: r for r in rows[rows.is_new == s].itertuples() if r.field is not None} for s in (False, True)}
    old, new = side[False], side[True]
    found = []
    moved = renames(old, new)
    found += [("renamed", a, b) for a, b in moved.items()]
    found += [("removed", a, "") for a in old if a not in new and a not in moved]
    found += [("added", b, "") for b in new if b not in old and b not in moved.values()]
    pairs = [(a, a) for a in old if a in new] + list(moved.items())
    found += [("retyped", a, "") for a, b in pairs if new[b].kind and old[a].held and new[b].kind != old[a].held]
    return pd.DataFrame([(source, seq, *x) for x in found], columns=["source_dataset_id", "file_seq", "change_kind", "field_name", "new_name"])


def schema_changes(records: DataFrame) -> DataFrame:
    """Each change between a registry's file and the one before it (file_seq - 1).

    Columns: source_dataset_id, file_seq, change_kind (added, removed, renamed,
    retyped), field_name, new_name ('' except for renamed). A file has a field
    if any readable record has it, even as null; a field's type is that of most
    of its non-null values, or the one it had before. First files, and files
    without a predecessor, give none. An empty table gives an empty result.
    Each task compares the fields of two files, never their records.
    """
    known = profiles(records)
    files = records.select("source_dataset_id", "file_seq").where("source_dataset_id is not null and file_seq is not null").distinct()
    side = lambda is_new, seq: F.struct(F.lit(is_new).alias("is_new"), seq.alias("file_seq"))
    sides = F.explode(F.array(side(True, F.col("file_seq")), side(False, F.col("file_seq") - 1))).alias("x")
    later = files.select("source_dataset_id", F.col("file_seq").alias("at_seq"), sides).select("source_dataset_id", "at_seq", "x.*")
    with_old = files.select("source_dataset_id", (F.col("file_seq") + 1).alias("at_seq"))
    pairs = later.join(with_old, ["source_dataset_id", "at_seq"], "left_semi").join(known, ["source_dataset_id", "file_seq"], "left")
    return pairs.groupBy("source_dataset_id", "at_seq").applyInPandas(_compare, CHANGES)


def _families(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
    parent: dict[str, str] = {}

    def root(x: str) -> str:
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for r in rows.sort_values("first_seq").itertuples():
        a, b = root(r.field_name), root(r.new_name)
        if a != b:
            parent[b] = a
    return pd.DataFrame([(rows.source_dataset_id.iloc[0], x, root(x)) for x in parent], columns=["source_dataset_id", "field", "family"])


def field_families(changes: DataFrame) -> DataFrame:
    """For each name that took part in a rename, the first name of its field."""
    moved = changes.where("change_kind = 'renamed'").groupBy("source_dataset_id", "field_name", "new_name").agg(F.min("file_seq").alias("first_seq"))
    return moved.groupBy("source_dataset_id").applyInPandas(_families, "source_dataset_id string, field string, family string")


def _fits() -> dict[str, Column]:
    """Whether a value (kind, text) stays what it is in a column of this type."""
    number = F.when(F.col("kind") == "number", ~F.col("text").rlike(r"^-?\d{16,}")).otherwise((F.col("kind") == "string") & F.col("text").rlike(r"^\s*[+-]?(0|[1-9]\d{0,14})(\.\d+)?\s*$"))
    return {"number": number, "boolean": F.col("text").try_cast("boolean").isNotNull()}


def unified_records(records: DataFrame, changes: DataFrame | None = None) -> DataFrame:
    """All readable records as one table: a renamed field under its first name, each in one type.

    A field whose values are mostly numbers becomes DOUBLE, mostly booleans
    BOOLEAN, others STRING (arrays and objects as JSON text); one with any value
    that this type wouldn't keep (other text, leading zeros, over 15 digits) is STRING
    too. Blank text is NULL in a typed column. A name that is taken, case ignored, gets an
    underscore. The columns' names are collected; more than MOST_FIELDS of them are a ValueError. Unreadable records are
    left out, a record without fields is a row of NULLs; source columns come first:
    rec_id, source_dataset_id, file_seq.
    """
    families = settled(field_families(schema_changes(records) if changes is None else changes))
    keys = ["rec_id", "source_dataset_id", "file_seq"]
    fields = json_fields(records.select(*keys, "payload"), keys)
    named = fields.join(families, ["source_dataset_id", "field"], "left").withColumn("name", F.coalesce("family", "field"))
    lost = {k: F.count_if(F.col("kind").isNotNull() & (F.trim("text") != "") & ~fits).alias(f"not_{k}") for k, fits in _fits().items()}
    found = named.groupBy("name").agg(F.mode("kind").alias("kind"), *lost.values()).orderBy("name").limit(MOST_FIELDS + 1).collect()
    if len(found) > MOST_FIELDS:
        raise ValueError(f"more than {MOST_FIELDS} different fields: these names are data, not a schema")
    types = {r["name"]: "string" if r["kind"] in lost and r[f"not_{r['kind']}"] else r["kind"] for r in found}
    wide = named.groupBy(*keys).pivot("name", list(types)).agg(F.first("text", ignorenulls=True)) if types else named.select(*keys).distinct()
    # By position, as names of JSON fields may differ in case only.
    wide = wide.toDF(*keys, *(f"_f{i}" for i in range(len(types))))
    empty = records.where(F.schema_of_variant(F.try_parse_json("payload")) == "OBJECT<>").select(*keys)
    wide = wide.unionByName(empty, allowMissingColumns=True)
    as_type = {"number": "double", "boolean": "boolean"}
    taken = {k.lower() for k in keys}
    out = []
    for i, (name, kind) in enumerate(types.items()):
        label = name
        while label.lower() in taken:
            label += "_"
        taken.add(label.lower())
        out.append(F.col(f"_f{i}").try_cast(as_type.get(kind, "string")).alias(label))
    return wide.select(*keys, *out)
