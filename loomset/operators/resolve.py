"""Entity resolution: lookups, repairs, duplicates and merges, each document on its own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..frames import ranked, unbroadcast, written
from ..functions import names as N
from ..plans.model import CLASS_KEY, Model, position
from .graph import connected_components

# Fixed values of the matching of packages.
LEAST_LENGTH, MOST_LONGER, LEAST_LONGER, MOST_EDITS = 5, 3, 1, 6
# Known misreadings, and the classes known beforehand.
CORRECTIONS = {"Meastrement": "Measurement", "Rep0rtingGroup": "ReportingGroup", "AuxiliarEuiment": "AuxiliaryEquipment", "DiaramLaout": "DiagramLayout"}
SEED_CLASSES = ["IdentifiedObject", "PowerSystemResource", "Measurement", "ReportingGroup", "DiagramLayout", "AuxiliaryEquipment"]
NAMESPACES = {
    "cim": "http://iec.ch/TC57/2024/CIM-schema-cim17#", "eu": "http://iec.ch/TC57/NonStandard/UML#", "rdf": "http://www.w3.org/1999/02/22-rdf-syntax-ns#", "rdfs": "http://www.w3.org/2000/01/rdf-schema#",
    "xsd": "http://www.w3.org/2001/XMLSchema#", "owl": "http://www.w3.org/2002/07/owl#", "sh": "http://www.w3.org/ns/shacl#", "skos": "http://www.w3.org/2004/02/skos/core#",
}
CANONICAL_PREFIXES = ["cim", "eu", "rdf", "rdfs", "xsd", "owl", "sh", "skos"]


def similar(left: DataFrame, right: DataFrame, most: int, within: list[str] | None = None, apart: int | None = None, allowed: Callable[[Column], Column] | None = None) -> DataFrame:
    """(…within, a, b, distance) of distinct names (…within, a) and (…within, b) that are at most ``most`` edits apart, and in length ``apart``;
    ``allowed`` gives the edits for the length of the longer one, ``most`` at most.

    No pair is compared that shares no piece: of two names within k edits, cut into k + 1 pieces, at least one piece of one stands in the
    other, shifted by no more than (k + apart) / 2. Names are cut for the edits that their lengths allow, so that short ones have no empty pieces
    as long as fewer edits than letters are. Both sides are joined on piece, lengths and place; the distance then settles it.
    """
    within, apart = within or [], most if apart is None else apart
    edits = lambda n: F.least(F.lit(most), allowed(n)).cast("int") if allowed else F.lit(most)
    a, b = left.select(*within, "a").where("a is not null").distinct(), right.select(*within, "b").where("b is not null").distinct()
    start = lambda n, i, k: F.floor((n * i) / (k + 1)).cast("int")
    la, lb, k, i = F.length("a"), F.col("lb"), F.col("k"), F.col("i")
    size = start(lb, i + 1, k) - start(lb, i, k)
    each = lambda lo, hi: F.explode(F.sequence(lo, hi))
    lengths = F.sequence(F.greatest(F.lit(0), F.length("b") - apart), F.length("b") + apart)
    pieces = b.select(*within, "b", F.length("b").alias("lb"), F.explode(F.array_distinct(F.transform(lengths, lambda n: edits(F.greatest(n, F.length("b")))))).alias("k"))
    pieces = pieces.select("*", each(F.lit(0), k).alias("i")).select(*within, "b", "lb", "k", "i", F.substring(F.col("b"), start(lb, i, k) + 1, size).alias("piece"))
    cuts = a.select(*within, "a", each(F.greatest(F.lit(0), la - apart), la + apart).alias("lb")).withColumn("k", edits(F.greatest(la, lb)))
    cuts = cuts.select("*", each(F.lit(0), k).alias("i"))
    reach = F.floor((k + apart) / 2).cast("int")
    shifted = F.transform(F.sequence(-reach, reach), lambda s: F.when(start(lb, i, k) + s >= 0, F.substring(F.col("a"), start(lb, i, k) + s + 1, size)))
    cuts = cuts.select(*within, "a", "lb", "k", "i", F.explode(F.array_distinct(shifted)).alias("piece")).where("piece is not null")
    pairs = unbroadcast(cuts).join(unbroadcast(pieces), [*within, "lb", "k", "i", "piece"]).select(*within, "a", "b", "k").distinct()
    return pairs.withColumn("distance", F.levenshtein("a", "b", most)).where("distance between 0 and k").drop("k")


def namespace_iri(prefix: Column, aliases: dict[str, str] | None = None, strict: bool = True) -> Column:
    """The namespace of a prefix, colons at its end left out; ``aliases`` stand for canonical prefixes. An unknown one is an error, or null if not
    ``strict``; a null prefix has none."""
    if bad := [c for c in (aliases or {}).values() if c not in NAMESPACES]:
        raise ValueError(f"no canonical prefix: {bad[0]!r}")
    table = NAMESPACES | {a: NAMESPACES[c] for a, c in (aliases or {}).items()}
    found = F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), F.regexp_replace(prefix, ":+$", ""))
    return F.coalesce(found, F.when(prefix.isNotNull(), F.raise_error(F.concat(F.lit("unknown namespace: "), prefix)).cast("string"))) if strict else found


def class_registry(rows: DataFrame, *order: str) -> DataFrame:
    """(name, package, place) of rows (name, package, …order): of a name the last package counts, and it stands where it came first. Rows without a name
    are none."""
    g = rows.where("name is not null").groupBy("name").agg(F.max_by(F.struct("package"), F.struct(*order)).alias("p"), F.min(F.struct(*order)).alias("first"))
    return ranked(g, [], ["first", "name"], "place").select("name", "p.package", "place")


def target_counts(targets: DataFrame) -> DataFrame:
    """How many associations each outcome of ``resolved_targets`` has, one row: those without any count 0."""
    kinds = ("noise_dropped", "kept_exact", "fuzzy_resolved", "ambiguous_kept", "unresolved_kept")
    return targets.agg(*[F.count_if(F.col("outcome") == k).alias(k) for k in kinds])


def nearest_prefix(found: DataFrame, most: int = 2, canonical: list[str] = CANONICAL_PREFIXES) -> DataFrame:
    """(prefix, nearest) of each distinct ``prefix`` that isn't canonical but at most ``most`` edits from one; ties go to the first."""
    choices = F.array(*[F.struct(F.levenshtein("prefix", F.lit(c)).alias("d"), F.lit(k).alias("k"), F.lit(c).alias("c")) for k, c in enumerate(canonical)])
    x = found.select("prefix").where("prefix is not null").distinct().withColumn("best", F.array_min(choices))
    return x.where((F.col("best.d") <= most) & (F.col("best.d") > 0)).select("prefix", F.col("best.c").alias("nearest"))


def clean_class_names(found: DataFrame, known: DataFrame, most: int = 2, suggestions: int = 3) -> DataFrame:
    """(name, value, correction_applied, uncertainty_reason, suggestions) of each distinct ``name``: known misreadings are corrected, known
    names kept, names near a known one are typos with the nearest ``suggestions`` (by distance, then name), others unknown."""
    x = found.select("name").where("name is not null").distinct()
    fix = F.create_map(*[F.lit(v) for kv in CORRECTIONS.items() for v in kv])
    near = similar(x.select(F.col("name").alias("a")), known.select(F.col("name").alias("b")), most)
    near = near.groupBy("a").agg(F.array_sort(F.collect_list(F.struct("distance", "b"))).alias("near")).select(F.col("a").alias("name"), F.transform(F.slice("near", 1, suggestions), lambda s: s["b"]).alias("near"))
    known = known.select("name").distinct().withColumn("known", F.lit(True))
    x = x.join(known, "name", "left").join(near, "name", "left").withColumn("fixed", F.try_element_at(fix, F.col("name")))
    plain = F.col("fixed").isNotNull() | F.coalesce("known", F.lit(False))
    return x.select(
        "name",
        F.coalesce("fixed", "name").alias("value"),
        F.col("fixed").isNotNull().alias("correction_applied"),
        F.when(~plain, F.when(F.col("near").isNotNull(), "possible_typo").otherwise("class_unknown")).alias("uncertainty_reason"),
        F.when(~plain, F.coalesce("near", F.array().cast("array<string>"))).otherwise(F.array().cast("array<string>")).alias("suggestions"),
    )


def ending_with(wanted: DataFrame, known: DataFrame, within: list[str] | None = None) -> DataFrame:
    """(…within, wanted, fits, only) of each distinct (…within, wanted) that known names (…within, name) end with and are longer than: how many, and
    the least of them. The ends of known names are joined by equality, not compared one by one; null and empty ones fit nothing."""
    within = within or []
    tails = F.transform(F.sequence(F.lit(2), F.length("name")), lambda k: F.when(F.length("name") >= k, F.substring("name", k, F.length("name"))))
    ends = known.where("name is not null").distinct().select(*within, "name", F.explode(tails).alias("wanted")).where("wanted is not null and wanted <> name")
    ends = unbroadcast(ends)  # many rows a name
    return wanted.where("wanted <> ''").distinct().join(ends, [*within, "wanted"]).groupBy(*within, "wanted").agg(F.count("*").alias("fits"), F.min("name").alias("only"))


def resolved_targets(m: Model) -> DataFrame:
    """The associations with ``class_name`` (repaired) and ``outcome``: noise (no class), kept, repaired by the only known name that ends with
    it, ambiguous or unresolved. The ends of known names are joined by equality, not compared one by one."""
    name = N.strip(F.col("target.class_name"))
    known = m.classes.select("doc_id", "name").where("name is not null").distinct()
    exact = known.select("doc_id", F.col("name").alias("wanted"), F.lit(True).alias("known"))
    a = m.association.withColumn("wanted", name)
    fits = ending_with(a.where(~N.is_noisy_target(F.col("target.class_name"))).select("doc_id", "wanted"), known, ["doc_id"])
    x = a.join(exact, ["doc_id", "wanted"], "left").join(fits, ["doc_id", "wanted"], "left")
    outcome = F.when(N.is_noisy_target(F.col("target.class_name")), "noise_dropped").when(F.col("known"), "kept_exact").when(F.col("fits") == 1, "fuzzy_resolved").when(F.col("fits") > 1, "ambiguous_kept").otherwise("unresolved_kept")
    x = x.withColumn("outcome", outcome)
    fixed = F.when(F.col("outcome") == "fuzzy_resolved", F.col("only")).when(F.col("outcome") != "noise_dropped", F.col("target.class_name"))
    return x.withColumn("class_name", fixed).drop("wanted", "known", "fits", "only")


def cleaned_attributes(m: Model) -> DataFrame:
    """The attributes with noisy names emptied (rows stay) and the kind of noise, null for kept ones."""
    kind = N.attribute_noise(F.col("name"))
    return m.attribute.withColumn("noise", kind).withColumn("name", F.when(F.col("noise").isNotNull(), "").otherwise(F.col("name")))


def _counts(m: Model) -> DataFrame:
    c = m.classes
    for t, n in ((m.attribute, "n_attr"), (m.association, "n_assoc"), (m.parent, "n_parent")):
        c = c.join(t.groupBy(*CLASS_KEY).agg(F.count("*").alias(n)), CLASS_KEY, "left")
    return c.fillna(0, ["n_attr", "n_assoc", "n_parent"])


def richest(m: Model) -> DataFrame:
    """The class kept for each name of a document: most attributes, then associations, then parents, then one with a description, then the
    first. Without its name a class is kept as it is. ``copies`` counts the classes of the name."""
    c = _counts(m).where("name is not null")
    described = (~N.blank(F.col("description"))).cast("int")
    rank = F.struct("n_attr", "n_assoc", "n_parent", described.alias("described"), (-F.col("pkg_ord")).alias("p"), (-F.col("cls_ord")).alias("c"))
    best = c.groupBy("doc_id", "name").agg(F.max_by(F.struct("pkg_ord", "cls_ord", "n_attr", "n_assoc", "n_parent"), rank).alias("k"), F.count("*").alias("copies"))
    return best.select("doc_id", "name", "k.*", "copies")


def _once(df: DataFrame) -> DataFrame:
    """``df`` written for the tables of the model that are all joined with it: else the plan of each holds all its steps, and the driver all plans."""
    return unbroadcast(written(df))


def _only(m: Model, keep: DataFrame) -> Model:
    keep = _once(keep.select(*CLASS_KEY))
    part = lambda t: t.join(keep, CLASS_KEY, "left_semi")
    return m.with_(classes=part(m.classes), parent=part(m.parent), attribute=part(m.attribute), association=part(m.association))


def without_copies(m: Model) -> Model:
    """One class of each name in a document, the richest; packages stay, even empty."""
    nameless = m.classes.where("name is null").select(*CLASS_KEY)
    return _only(m, richest(m).select(*CLASS_KEY).unionByName(nameless))


def fuzzy_pairs(m: Model) -> DataFrame:
    """(doc_id, a, b, distance) of package names that are misreadings of each other: five letters or more, one to three letters longer or
    shorter, and no more edits than a third of the longer one (two at least, six at most)."""
    names = m.package.where(F.length("name") >= LEAST_LENGTH).select("doc_id", "name").distinct()
    third = lambda n: F.greatest(F.lit(2), F.floor(n / 3))
    p = similar(names.select("doc_id", F.col("name").alias("a")), names.select("doc_id", F.col("name").alias("b")), MOST_EDITS, ["doc_id"], MOST_LONGER, third).where("a < b")
    return p.where(F.abs(F.length("a") - F.length("b")).between(LEAST_LONGER, MOST_LONGER))


def sorted_refs(m: Model) -> DataFrame:
    """``cross_package_refs`` in the order of package, referred package and class."""
    return cross_package_refs(m).orderBy("doc_id", "from_package", "to_package", "via_class")


def merged_names(m: Model, fuzzy: bool = True) -> DataFrame:
    """(doc_id, pkg_ord, canonical, canonical_ord): the package each package goes into. Packages of one name go into the first; with ``fuzzy``,
    misreadings go together, under the longest name (the earliest of several), in the place of the first member."""
    first = m.package.where("name is not null").groupBy("doc_id", "name").agg(F.min("pkg_ord").alias("first"))
    if not fuzzy:
        return m.package.join(first, ["doc_id", "name"]).select("doc_id", "pkg_ord", F.col("name").alias("canonical"), F.col("first").alias("canonical_ord"))
    key = lambda c: F.concat_ws("/", "doc_id", c)
    nodes = first.select(key("name").alias("id"), "doc_id", "name", "first")
    groups = connected_components(nodes.select("id"), fuzzy_pairs(m).select(key("a").alias("a"), key("b").alias("b")))
    g = nodes.join(groups, "id")
    best = g.groupBy("doc_id", "component").agg(F.max_by("name", F.struct(F.length("name"), -F.col("first"))).alias("canonical"), F.min("first").alias("canonical_ord"))
    return m.package.join(g.join(best, ["doc_id", "component"]).select("doc_id", "name", "canonical", "canonical_ord"), ["doc_id", "name"]).select("doc_id", "pkg_ord", "canonical", "canonical_ord")


def merged_packages(m: Model, fuzzy: bool = True) -> Model:
    """The model with packages merged as ``merged_names`` says. The first package's data stand for all; its classes are all kept, of the others'
    those of new names, the first of each."""
    to = _once(merged_names(m, fuzzy))
    c = m.classes.join(to, ["doc_id", "pkg_ord"])
    own = F.col("pkg_ord") == F.col("canonical_ord")
    first = c.groupBy("doc_id", "canonical_ord", "name").agg(F.min(F.struct((~own).alias("later"), "pkg_ord", "cls_ord")).alias("f")).select("doc_id", "f.pkg_ord", "f.cls_ord", F.lit(True).alias("first"))
    kept = c.join(first, CLASS_KEY, "left").where(own | F.col("first"))
    # classes of later packages follow those of the first: their ordinals are shifted by package
    moved = _once(ranked(kept.select(*CLASS_KEY, F.col("canonical_ord").alias("to_pkg")), ["doc_id", "to_pkg"], ["pkg_ord", "cls_ord"], "to_cls").withColumn("to_cls", F.col("to_cls").cast("int")))
    part = lambda t: t.join(moved, CLASS_KEY).drop("pkg_ord", "cls_ord").withColumnsRenamed({"to_pkg": "pkg_ord", "to_cls": "cls_ord"}).select(*t.columns)
    heads = m.package.join(to.where("pkg_ord = canonical_ord"), ["doc_id", "pkg_ord"]).withColumn("name", F.col("canonical")).select(*m.package.columns)
    enums = m.enumeration.join(to, ["doc_id", "pkg_ord"]).withColumn("pkg_ord", F.col("canonical_ord")).select(*m.enumeration.columns)
    return Model(heads, part(m.classes), part(m.parent), part(m.attribute), part(m.association), enums)


def cross_package_refs(m: Model) -> DataFrame:
    """(doc_id, from_package, to_package, via_class, via_property), one row for each class of another package that a package's classes name as
    parent or target; of several classes of a name the last one's package counts, of several references the last one's property. Parents come
    before associations in each class."""
    named = m.named().where("name is not null")
    index = named.groupBy("doc_id", "name").agg(F.max_by("package", position("pkg_ord", "cls_ord")).alias("to_package"))
    holder = named.select(*CLASS_KEY, "package", F.col("name").alias("holder"))
    parents = m.parent.select(*CLASS_KEY, F.lit(0).alias("phase"), F.col("par_ord").alias("ord"), F.col("class_name").alias("name"), F.lit(None).cast("string").alias("via"))
    targets = m.association.select(*CLASS_KEY, F.lit(1).alias("phase"), F.col("assoc_ord").alias("ord"), F.col("target.class_name").alias("name"), F.col("name").alias("via"))
    refs = unbroadcast(parents.unionByName(targets).where("name is not null and name <> ''")).join(holder, CLASS_KEY).join(index, ["doc_id", "name"]).where("package <> to_package")
    via = F.when(F.col("phase") == 0, F.concat(F.lit("parent:"), F.col("holder"))).otherwise(F.col("via"))
    last = F.max_by(via, position("pkg_ord", "cls_ord", "phase", "ord"))
    return refs.groupBy("doc_id", F.col("package").alias("from_package"), "to_package", F.col("name").alias("via_class")).agg(last.alias("via_property"))


def dangling_refs(m: Model) -> DataFrame:
    """(doc_id, kind, pkg_ord, cls_ord, ord, package, class_name) of parents and targets whose package and class aren't in the document."""
    there = m.named().select("doc_id", "package", F.col("name").alias("class_name")).distinct()
    parents = m.parent.select(*CLASS_KEY, F.lit("parent").alias("kind"), F.col("par_ord").alias("ord"), "package", "class_name")
    targets = m.association.select(*CLASS_KEY, F.lit("target").alias("kind"), F.col("assoc_ord").alias("ord"), "target.package", "target.class_name")
    return parents.unionByName(targets).where("class_name is not null").join(there, ["doc_id", "package", "class_name"], "left_anti")


def last_by_key(rows: DataFrame, keys: list[str], *order: Column | str) -> DataFrame:
    """The last row of each key: an upsert log read back."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("row")).select(*keys, "row.*")
