"""DataFrame-to-DataFrame operators; none of them writes."""
