"""Job: a sample of the raw events as a table."""

from clickmart.metrics import counted, rows_of
from clickmart.operators.sampling import sample
from clickmart.session import prepare_session
from clickmart.sources.writers import write_table


def run(events, table, key, size=100_000, mode="random", seed=0, keep_target=False):
    """Writes ``size`` events to ``table`` and returns how many there were."""
    prepare_session(events.sparkSession)
    rows, written = counted(sample(events, size, key, mode, seed), "sampled_rows")
    write_table(rows, table, keep=keep_target)
    return rows_of(written)["rows"]
