"""postern: set-at-a-time routing of incoming document events on Spark.

A gated event is joined with its journal entry, the identities of the entry's party, the
open tasks and the code hierarchy; one ordered decision table gives every entry an outcome;
task requests, journal updates and delayed retries are projections of that result. Batch
jobs and streams call the same functions.
"""
