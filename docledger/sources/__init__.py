"""Sources and sinks: folders of files, tables, generators, exports, mail."""
