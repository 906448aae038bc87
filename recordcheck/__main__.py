"""Command line: audit a delimited file and write the outputs.

    python -m recordcheck --input data/*.csv --output /shared/out --run-id 20250630 [--csv]

Reads a ';' separated table with a header that holds the 54 fields (in any order,
more columns are audited too; --fixed-fields asks for exactly these), evaluates the catalogue once,
writes the six parquet outputs under ``<output>/resultados_<run-id>`` and
prints the global totals.
"""

from __future__ import annotations

import argparse
import json


def main(argv=None, spark=None) -> str:
    ap = argparse.ArgumentParser(prog="recordcheck")
    ap.add_argument("--input", required=True, help="delimited file(s) or folder")
    ap.add_argument("--output", required=True, help="root folder of the outputs")
    ap.add_argument("--run-id", default=None, help="run stamp of the output folder (default 20250630)")
    ap.add_argument("--sep", default=";")
    ap.add_argument("--csv", action="store_true", help="also write ';' CSV copies of three outputs")
    ap.add_argument("--extended", action="store_true", help="add the extended requirement rules")
    ap.add_argument("--unicode-case", action="store_true",
                    help="placeholder words also match accented capitals (default: ASCII folding)")
    ap.add_argument("--ignore-corrupt-files", action="store_true")
    ap.add_argument("--quarantine", action="store_true",
                    help="lines with too few or too many fields or undecodable bytes are not audited but written "
                         "to lineas_rechazadas")
    ap.add_argument("--fixed-fields", action="store_true",
                    help="the header must be the 54 fields in order; field indices are their codes")
    args = ap.parse_args(argv)

    from pyspark.sql import SparkSession

    from recordcheck import constants as K
    from recordcheck.plans.audit import Audit
    from recordcheck.plans.catalog_party import party_catalog
    from recordcheck.sources.delimited import read_delimited, read_quarantined

    # The projection of all rules never fits one fused method (64 KB limit):
    # skip compiling it twice in vain (see README, "Codegen settings").
    spark = spark or (SparkSession.builder.appName("recordcheck")
                      .config("spark.sql.codegen.wholeStage", "false").getOrCreate())
    fields, extra = K.FIELDS if args.fixed_fields else None, {}
    if args.quarantine:
        df, extra["lineas_rechazadas"] = read_quarantined(spark, args.input, fields=fields, sep=args.sep)
    else:
        df = read_delimited(spark, args.input, fields=fields, sep=args.sep, ignore_corrupt_files=args.ignore_corrupt_files)
    catalog = party_catalog(df.columns, extended=args.extended, unicode_case=args.unicode_case,
                            header=not args.fixed_fields)
    with Audit(df, catalog=catalog) as audit:
        out = audit.write(args.output, args.run_id or K.DEFAULT_RUN_ID, csv=args.csv, extra=extra)
        totals = audit.type_totals().collect()[0].asDict()
        counts = audit.record_counts().collect()[0].asDict()
    print(json.dumps({"output": out, **counts, **totals}))
    return out


if __name__ == "__main__":
    main()
