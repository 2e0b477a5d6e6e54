"""Table and message sources/sinks."""
