"""Landing event files as they arrive, with the same reader and landing columns as the batch path."""
