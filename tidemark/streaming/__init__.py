"""The landing flow and its monitoring as Structured Streaming."""
