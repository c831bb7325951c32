"""Command line: documents to files, packages of IR documents, and checks of both."""

from __future__ import annotations

import argparse
import os

from .frames import written
from .plans import emit
from .plans.package import Packages
from .plans.pipeline import build
from .session import local_session
from .sinks import write_files
from .sources import markdown
from .sources.models import ir_documents, known_classes
from .sources.providers import from_settings


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="loomset", description=__doc__)
    sub = p.add_subparsers(dest="do", required=True)
    for name, text in (("build", "Markdown documents to files of one or more forms"), ("package", "IR documents to semantic packages"), ("verify", "read back what build would write")):
        s = sub.add_parser(name, help=text)
        s.add_argument("-i", "--input", required=True)
        if name != "verify":
            s.add_argument("-o", "--output", required=True)
        if name != "package":
            s.add_argument("-f", "--form", action="append", choices=sorted(emit.ADAPTERS))
    sub.choices["package"].add_argument("--package-id")
    sub.choices["build"].add_argument("--review", action="store_true", help="ask the reviewer that the environment names about uncertain entries")
    sub.choices["build"].add_argument("--cache", help="folder of the response log")
    sub.choices["build"].add_argument("--known", help="list of class names that corrections may give")
    sub.choices["build"].add_argument("--listed", type=int, default=200, help="most issues that are printed")
    a = p.parse_args(args)
    spark = local_session()
    if a.do == "package":
        files = Packages(ir_documents(spark, a.input)).files()
        files = files.where(files.package_id == a.package_id) if a.package_id else files
        n = write_files(files, a.output).count()
        print(f"{n} files")
        return 0 if n else 1
    if a.do == "build":
        provider = from_settings(os.environ) if a.review else None
        if a.review and provider is None:
            print("no reviewer is set: entries stay uncertain")
        built = build(spark, a.input, a.output, a.form, provider, known_classes(spark, a.known) if a.known else None, a.cache)
        print(*(f"{form}: {n} files" for form, n in sorted(built.stats.items())), sep="\n")
        issues = built.issues
    else:
        m = markdown.resolved(markdown.model(markdown.documents(spark, a.input))[0])
        issues = emit.verified(emit.emitted(m, a.form))
    issues = written(issues)
    n, listed = issues.count(), getattr(a, "listed", 200)
    print(*(f"{i.path}: {i.issue}" for i in issues.limit(listed).collect()), *[f"and {n - listed} more"] * (n > listed), sep="\n")
    return int(n > 0)


if __name__ == "__main__":
    raise SystemExit(main())
