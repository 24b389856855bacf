"""DataFrame -> DataFrame operators; lazy, and the same for batch data and micro-batches."""
