"""Sources and sinks: tab-separated record files, truth lists, folds, id lists."""
