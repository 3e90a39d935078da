"""Fixtures derived from the test tables, as SQL that Spark and DuckDB both run.

``{name}`` stands for a table or another fixture.
"""

FIXTURES = {
    "fx_sites": """
        SELECT min(page_id) + 1 AS site_id, host AS domain, concat('https://', host) AS start_url,
               CAST(NULL AS TIMESTAMP) AS last_visited, (min(page_id) + 1) % 5 <> 0 AS active,
               CAST((min(page_id) + 1) % 10 + 1 AS INT) AS priority
        FROM (SELECT page_id, replace(lower(split_part(url, '/', 3)), 'www.', '') AS host
              FROM {pages}) AS hosts
        GROUP BY host
    """,
    "fx_pages": """
        SELECT page_id,
               CASE WHEN page_id % 13 = 0
                    THEN concat(split_part(url, '/', 1), '//', split_part(url, '/', 3),
                                '/2024/01/02',
                                substr(url, length(split_part(url, '/', 1))
                                            + length(split_part(url, '/', 3)) + 3))
                    ELSE url END AS url,
               replace(replace(html, '</article>', concat(links, figure, follow, '</article>')),
                       '</head>', concat(head, '</head>')) AS html
        FROM (SELECT page_id, url,
                     CASE WHEN page_id % 11 = 0
                          THEN concat(split_part(html, '<article>', 1),
                                      '<article><p>Follow us</p><p>Follow us for story number ',
                                      page_id,
                                      ' &amp; more</p><p>var follow = "Follow us"; ',
                                      chr(123), chr(125), '</p></article>',
                                      split_part(html, '</article>', 2))
                          ELSE html END AS html,
                     CASE WHEN page_id % 3 = 0 AND page_id % 11 <> 0
                          THEN concat('<p>See <a href="https://',
                                      replace(lower(split_part(url, '/', 3)), 'www.', ''),
                                      '/news/', page_id % 40, '?ref=1&amp;x=2">one</a> ',
                                      '<a href="https://other.example.edu/story/', page_id,
                                      '">two</a> <a href="mailto:desk@example.com">three</a> ',
                                      '<a href="#x">four</a> <a href="../y/', page_id % 7,
                                      '">five</a> <a class="b" href=''../y/', page_id % 7,
                                      '''>six</a></p>')
                          ELSE '' END AS links,
                     CASE WHEN page_id % 4 = 0
                          THEN concat('<figure><img alt="i" src="/img/', page_id,
                                      '.jpg"></figure>')
                          ELSE '' END AS figure,
                     CASE WHEN page_id % 7 = 0 THEN '<p>Follow us on the wire</p>'
                          ELSE '' END AS follow,
                     concat(CASE WHEN page_id % 5 = 0
                                 THEN concat('<meta property="og:image" content="og/', page_id,
                                             '.png?w=1">')
                                 ELSE '' END,
                            CASE WHEN page_id % 6 = 0
                                 THEN '<meta name="author" content="Desk">' ELSE '' END,
                            CASE WHEN page_id % 12 = 0
                                 THEN '<meta property="article:published_time" content="2024-01-02">'
                                 ELSE '' END) AS head
              FROM {pages}) AS marked
    """,
    "fx_linked": """
        SELECT page_id, url,
               CASE WHEN page_id % 2 = 0
                    THEN replace(html, '</article>',
                                 concat('<p>Seen <a href="', url, '">here</a></p></article>'))
                    ELSE html END AS html
        FROM {fx_pages}
    """,
    # Pages whose elements are nested, whose attributes hold brackets, and whose text is not all in one article.
    "fx_nested": """
        SELECT page_id, url,
               CASE page_id % 6
               WHEN 0 THEN concat(head, '<main><p>An introduction that stands before the articles, number ', page_id,
                   '.</p><article>', body, '</article><div><a href="/mid/', page_id,
                   '">Related reading</a></div><article><p>Second text.</p><article><p>A nested text that is long enough, ',
                   page_id, '</p></article><a href="/in/', page_id,
                   '">in</a></article><p>And some closing words after the last of the articles.</p></main><a href="/out/',
                   page_id, '">out</a>', tail)
               WHEN 1 THEN concat(head, '<div class="main-content wide"><div><p>The lead of page number ', page_id,
                   '</p></div>', body, '<div class="x post-body"><p>Inner words of page number ', page_id,
                   '</p></div><p>The tail of page number ', page_id, '</p></div>', tail)
               WHEN 2 THEN concat(head, '<img src="/lead/', page_id,
                   '.jpg"><figure><figure><figcaption>Caption</figcaption></figure><img alt="1 > 0" src="/fig/', page_id,
                   '.jpg"></figure><article>', body, '</article>', tail)
               WHEN 3 THEN concat(head, '<article data-x="a > b"><p title=''x > y < z''>T', page_id, '</p>', body,
                   '<article>z</article><a title="more > less" href="/q/', page_id, '?z=1">q</a><img src="/art/', page_id,
                   '.jpg"></article><a href="/after/', page_id, '">after</a>', tail)
               WHEN 4 THEN concat(head, '<section><ul><li><a href="/l1/', page_id,
                   '">First of many links</a></li><li><a href="/l2">Second of many links</a></li></ul>', body,
                   '<p>Short.</p><p>A closing paragraph of page number ', page_id,
                   ', long enough to count.</p><ul><li><a href="/l3">Third of the links</a></li></ul></section>', tail)
               ELSE concat(head, '<main><section><main>', body, '</main><a href="/p/', page_id,
                   '">p</a></section></main><a href="/r/', page_id, '">r</a>', tail) END AS html
        FROM (SELECT page_id, url, split_part(html, '<article>', 1) AS head,
                     split_part(split_part(html, '<article>', 2), '</article>', 1) AS body,
                     split_part(html, '</article>', 2) AS tail
              FROM {pages}) AS parts
    """,
    "fx_src_sites": """
        SELECT CAST(substr(source, 4) AS BIGINT) + 1 AS site_id,
               concat(CASE WHEN substr(source, 4) = '2' THEN 'www.' ELSE '' END,
                      source, '.example.com') AS domain,
               concat('https://', source, '.example.com') AS start_url,
               CAST(NULL AS TIMESTAMP) AS last_visited,
               CAST(substr(source, 4) AS BIGINT) % 7 <> 3 AS active,
               CAST(CAST(substr(source, 4) AS BIGINT) % 10 + 1 AS INT) AS priority
        FROM (SELECT DISTINCT source FROM {documents}) AS sources
    """,
    "fx_docs": """
        SELECT doc_id, source, concat('https://', source, '.example.com/', doc_id) AS url,
               CAST(substr(source, 4) AS BIGINT) + 1 AS site_id,
               CASE WHEN doc_id % 7 = 0 THEN CAST(NULL AS STRING)
                    WHEN doc_id % 7 = 1 THEN ''
                    ELSE concat('Doc ', doc_id) END AS title,
               CASE WHEN doc_id % 3 = 0 THEN concat('https://img.example.com/', doc_id, '.jpg')
                    ELSE CAST(NULL AS STRING) END AS image,
               text
        FROM {documents}
    """,
    # State: two thirds of the documents, some without a stored hash.
    "fx_state": """
        SELECT doc_id + 1 AS article_id, site_id, url, concat('Old ', doc_id) AS title,
               text AS body, '' AS image_url,
               CASE WHEN doc_id % 19 = 0 THEN CAST(NULL AS STRING) ELSE md5(text) END
                   AS content_hash,
               TIMESTAMP '2024-01-15 00:00:00' AS scraped_at,
               TIMESTAMP '2024-01-15 00:00:00' AS last_cited_date
        FROM {fx_docs} WHERE doc_id % 3 <> 0
    """,
    # Batch: all documents, some edited, some twice with a second edit.
    "fx_batch": """
        SELECT url, site_id, doc_id * 2 AS ingest_seq, title, image,
               CASE WHEN doc_id % 5 = 0 THEN concat(text, ' (edited)') ELSE text END AS body
        FROM {fx_docs}
        UNION ALL
        SELECT url, site_id, doc_id * 2 + 1 AS ingest_seq,
               CASE WHEN doc_id % 2 = 0 THEN 'Second' ELSE title END AS title, image,
               CASE WHEN doc_id % 34 = 0 THEN concat(text, ' (again)')
                    WHEN doc_id % 5 = 0 THEN concat(text, ' (edited)') ELSE text END AS body
        FROM {fx_docs} WHERE doc_id % 17 = 0
    """,
    # State and batch whose URLs differ in case and accents, also those of one article within the batch.
    "fx_fold_state": """
        SELECT article_id, site_id,
               concat(CASE WHEN article_id % 3 = 0 THEN upper(url) ELSE url END,
                      CASE WHEN article_id % 2 = 0 THEN '/ΆρθρΟσ' ELSE '/été' END) AS url,
               title, body, image_url, content_hash, scraped_at, last_cited_date
        FROM {fx_state}
    """,
    "fx_fold_batch": """
        SELECT concat(CASE WHEN ingest_seq % 5 = 0 THEN upper(url) ELSE url END,
                      CASE WHEN (article_id % 2 = 0) AND ingest_seq % 7 < 3 THEN '/αρθρος'
                           WHEN article_id % 2 = 0 THEN '/ΆΡΘΡΟΣ'
                           WHEN ingest_seq % 7 < 3 THEN '/ETE' ELSE '/étÈ' END) AS url,
               site_id, ingest_seq, title, image, body
        FROM (SELECT *, CAST(split_part(url, '/', 4) AS BIGINT) + 1 AS article_id FROM {fx_batch}) AS numbered
    """,
    # Rows of the batch with URLs of more than 255 characters, in clashing pairs.
    "fx_long": """
        SELECT concat(b.url, '/', repeat('x', 260 - CAST(b.ingest_seq % 20 AS INT)),
                      CAST(b.ingest_seq % 2 AS STRING)) AS url,
               b.ingest_seq AS ingest_seq, CASE WHEN b.ingest_seq % 9 = 0 THEN -1 ELSE b.site_id END AS site_id
        FROM {fx_batch} AS b
        UNION ALL
        SELECT concat(b.url, '/', repeat('x', 260), 'z') AS url,
               b.ingest_seq + 10000000000 AS ingest_seq, b.site_id AS site_id
        FROM {fx_batch} AS b
    """,
    "fx_labelled": """
        SELECT d.doc_id AS doc_id, concat('https://', d.source, '.example.com/', d.doc_id) AS url,
               CASE WHEN d.doc_id % 4 = 0 THEN CAST(NULL AS STRING)
                    ELSE concat('Title ', d.lang, ' ', d.doc_id) END AS title,
               d.text AS article_body,
               concat('/html/body/', CASE WHEN l.quality = 1 THEN 'main/Article' ELSE 'div' END,
                      CASE WHEN d.doc_id % 2 = 0 THEN '/story' ELSE '' END) AS xpath,
               l.toxic = 1 AS is_category_link,
               CASE WHEN d.doc_id % 23 = 0 THEN CAST(NULL AS STRING)
                    WHEN l.quality = 1 AND l.toxic = 0 THEN 'article'
                    WHEN l.quality = 1 THEN 'category' ELSE 'other' END AS label
        FROM {documents} AS d JOIN {labels} AS l ON d.doc_id = l.doc_id
    """,
    # A rule in place of the model, so that reports can be compared exactly.
    "fx_predicted": """
        SELECT url, label,
               CASE WHEN length(article_body) > 1500 THEN 'article'
                    WHEN length(article_body) > 400 THEN 'category' ELSE 'other' END
                   AS predicted_label
        FROM {fx_labelled} WHERE label IS NOT NULL
    """,
    # Page items of the site reports: documents by source, some sources left out.
    "fx_items": """
        SELECT concat(source, '.example.com') AS site_domain, url, doc_id
        FROM {fx_docs} WHERE CAST(substr(source, 4) AS BIGINT) % 6 <> 5
    """,
    "fx_changes": """
        SELECT concat(source, '.example.com') AS domain, url, doc_id,
               CASE WHEN doc_id % 5 < 2 THEN 'NEW' WHEN doc_id % 5 < 4 THEN 'UNCHANGED'
                    ELSE 'UPDATED' END AS status
        FROM {fx_docs} WHERE CAST(substr(source, 4) AS BIGINT) % 6 <> 5 AND doc_id % 3 <> 0
    """,
}

# Keyword lists of the frontier queries.
CATEGORY_WORDS = {"press": ["/EN/", "world"], "desk": ["/news/"]}
GENERAL_WORDS = ["category"]
IRRELEVANT_WORDS = ["/de/", "print", "pdf", "/y/1"]

# Cleanup patterns of the sites with an odd id.
RULE_PATTERNS = [r"\s+of [a-z]+[.]", r" or [a-z]*tion.*"]

RUN_TS = "2024-02-01 00:00:00"
