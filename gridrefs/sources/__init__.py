"""Sources and sinks: reference documents, manifests, logs, configs, stores and reports."""
