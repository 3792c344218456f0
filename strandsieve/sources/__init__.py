"""Readers and writers: FASTA, FASTQ, tables with exact headers, designs, and the published layout."""
