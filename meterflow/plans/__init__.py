"""Assembled jobs: producer side (telegrams -> messages), consumer side
(messages -> raw tables and ledger), table setup and sinks."""
