"""The change log as a stream and sinks for its batches."""
