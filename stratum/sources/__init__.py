"""Sources and sinks: bronze files, scraped datasets, JSON documents, state tables."""
