"""Sources: generators and table scans."""
