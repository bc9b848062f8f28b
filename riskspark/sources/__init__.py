"""Sources and sinks: driver tables, proxy views, file formats, versioned datasets."""
