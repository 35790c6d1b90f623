"""Named queries over the tables of a data folder, each with the SQL that gives the same rows."""

from seqloom.plans import files, metadata, reads, records, runtime

REGISTRIES = [reads.registry, metadata.registry, records.registry, runtime.registry, files.registry]
QUERIES = {name: f for r in REGISTRIES for name, f in r.queries.items()}
ORACLES = {name: sql for r in REGISTRIES for name, sql in r.oracles.items()}
