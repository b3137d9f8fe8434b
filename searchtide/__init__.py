"""Search-event analytics as Spark jobs: curate raw events, report on them, keep the keyword table fresh."""
